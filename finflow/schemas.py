"""Declarative data of the pipeline: datasets, staging targets, rule tables, alias maps.

Everything here is data, not logic; the operators read it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the behaviour being reproduced (names, lists, limits).
# ---------------------------------------------------------------------------

DATASETS = [
    "customers", "dealers", "vehicles", "sales", "inventory",
    "payments", "suppliers", "procurement", "interactions", "telemetry",
]

# Required and critical columns per dataset (file gate).
QUALITY_RULES = {
    "customers": {"required": ["customer_id", "email"], "critical": ["customer_id"]},
    "dealers": {"required": ["dealer_id"], "critical": ["dealer_id"]},
    "vehicles": {"required": ["vehicle_id", "dealer_id"], "critical": ["vehicle_id"]},
    "sales": {"required": ["sale_id", "sale_date"], "critical": ["sale_id", "sale_date"]},
    "inventory": {"required": ["inventory_id", "vehicle_id"], "critical": ["inventory_id"]},
    "payments": {"required": ["payment_id", "payment_date"], "critical": ["payment_id", "payment_date"]},
    "suppliers": {"required": ["supplier_id"], "critical": ["supplier_id"]},
    "procurement": {"required": ["procurement_id", "supplier_id"], "critical": ["procurement_id", "supplier_id"]},
    "interactions": {"required": ["interaction_id", "customer_id"], "critical": ["interaction_id", "customer_id"]},
    "telemetry": {"required": ["telemetry_id", "timestamp"], "critical": ["telemetry_id", "timestamp"]},
}

# Dataset name aliases, tested as substrings of the normalised file stem, in this order.
TABLE_ALIASES = [
    ("interactions", ["customer_interactions", "interaction"]),
    ("customers", ["crm_customers", "customer"]),
    ("dealers", ["dealer"]),
    ("vehicles", ["vehicle"]),
    ("sales", ["sales"]),
    ("inventory", ["inventory"]),
    ("payments", ["payment", "erp_finance"]),
    ("suppliers", ["supplier"]),
    ("procurement", ["procurement", "purchase_order", "purchase_orders", "order"]),
    ("telemetry", ["telemetry", "sensor", "iot_sensors"]),
]

# Suffixes removed from a file stem after its trailing numeric groups.
STEM_SUFFIXES = ["auto", "consolidated", "e2e_test", "catalog_e2e_test", "readings_e2e_test"]

# Column renames per dataset: source name -> canonical name (applied only if target absent).
COLUMN_ALIASES = {
    "customers": [("created_date", "created_at"), ("zip", "zip_code")],
    "interactions": [("type", "interaction_type"), ("timestamp", "interaction_date"),
                     ("created_date", "interaction_date"), ("subject", "notes")],
    "payments": [("transaction_id", "payment_id"), ("transaction_date", "payment_date"),
                 ("payment_amount", "amount"), ("payment_status", "status")],
    "suppliers": [("contact_person", "contact_name"), ("email", "contact_email"),
                  ("phone", "contact_phone"), ("zip", "zip_code"), ("created_date", "created_at")],
    "procurement": [("po_id", "procurement_id"), ("vendor_id", "supplier_id"),
                    ("po_date", "procurement_date"), ("amount", "cost"),
                    ("procurement_status", "status")],
    "telemetry": [("device_id", "telemetry_id"), ("reading_type", "sensor_type"),
                  ("reading_value", "sensor_value")],
}

# Status recodes, keyed by the lower-cased trimmed value; unknown values are kept.
PAYMENT_STATUS_MAP = {
    "completed": "Paid", "paid": "Paid", "pending": "Pending", "failed": "Failed",
    "cancelled": "Failed", "canceled": "Failed", "refunded": "Refunded",
}
PROCUREMENT_STATUS_MAP = {
    "ordered": "Ordered", "received": "Received", "returned": "Returned",
    "pending": "Ordered", "completed": "Received",
}

# Categorical rules: column -> allowed values (case-sensitive; null is not allowed).
CATEGORICAL_RULES = {
    "gender": ["M", "F", "Other"],
    "status": ["Active", "Inactive", "Pending", "Closed"],
    "province": ["AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT"],
    "engine_type": ["Gasoline", "Diesel", "Electric", "Hybrid", "Plug-in Hybrid"],
    "transmission": ["Manual", "Automatic", "CVT"],
    "vehicle_status": ["Available", "Sold", "Reserved", "Damaged"],
    "sale_channel": ["Dealership", "Online", "Auction", "Private"],
    "sale_status": ["Completed", "Pending", "Cancelled"],
    "stock_status": ["In Stock", "Out of Stock", "Coming Soon"],
    "interaction_type": ["Phone", "Email", "Chat", "In-Person"],
    "interaction_channel": ["Sales", "Support", "Marketing"],
    "outcome": ["Won", "Lost", "Pending", "Cancelled"],
    "payment_method": ["Credit Card", "Debit Card", "Check", "Bank Transfer"],
    "payment_status": ["Paid", "Pending", "Failed", "Refunded"],
    "procurement_status": ["Ordered", "Received", "Returned"],
}
STATUS_OVERRIDES = {
    "payments": ["Paid", "Pending", "Failed", "Refunded"],
    "procurement": ["Ordered", "Received", "Returned"],
}

# File gate.
MAX_FILE_BYTES = 500 * 1024 * 1024
GATE_EXTENSIONS = ["csv", "json", "xlsx", "parquet", "avro"]
ETL_EXTENSIONS = ["csv", "json", "xlsx"]
FILE_TYPES = {"csv": "CSV", "json": "JSON", "xlsx": "Excel", "parquet": "Parquet", "avro": "Avro"}

# Domain constraints of the datasets' rows: rule name -> (predicate, columns it needs). As in a
# CHECK constraint a null passes. Text columns are read as numbers where they hold one.
ROW_CHECKS = {
    "customers": {
        "email_format": ("email RLIKE '^[^@ ]+@[^@ ]+[.][^@ ]+$'", ["email"]),
    },
    "vehicles": {
        "year_range": ("try_cast(year AS INT) BETWEEN 1980 AND 2100", ["year"]),
    },
    "sales": {
        "sale_price_not_negative": ("sale_price >= 0", ["sale_price"]),
        "discount_not_negative": ("discount_amount >= 0", ["discount_amount"]),
        "final_price_not_negative": ("final_price >= 0", ["final_price"]),
    },
    "payments": {
        "amount_positive": ("amount > 0", ["amount"]),
    },
    "procurement": {
        "cost_not_negative": ("try_cast(cost AS DECIMAL(18,2)) >= 0", ["cost"]),
        "quantity_positive": ("try_cast(quantity AS INT) > 0", ["quantity"]),
    },
    "inventory": {
        "quantity_not_negative": ("try_cast(quantity AS INT) >= 0", ["quantity"]),
    },
    "interactions": {
        "duration_positive": ("try_cast(duration_minutes AS DOUBLE) > 0", ["duration_minutes"]),
    },
    "telemetry": {
        "speed_range": ("sensor_type <> 'speed' OR try_cast(sensor_value AS DOUBLE) BETWEEN 0 AND 350", ["sensor_type", "sensor_value"]),
        "fuel_level_range": ("sensor_type <> 'fuel_level' OR try_cast(sensor_value AS DOUBLE) BETWEEN 0 AND 100", ["sensor_type", "sensor_value"]),
        "engine_temperature_range": ("sensor_type <> 'engine_temperature' OR try_cast(sensor_value AS DOUBLE) BETWEEN -50 AND 250",
                                     ["sensor_type", "sensor_value"]),
    },
}
# Longest text of a column, in characters.
MAX_LENGTHS = {
    "customers": {"customer_id": 64, "first_name": 100, "last_name": 100, "email": 255, "phone": 50, "city": 100, "zip_code": 20},
    "dealers": {"dealer_id": 64, "dealer_name": 255, "contact_name": 100, "contact_email": 255, "contact_phone": 50, "city": 100, "zip_code": 20},
    "vehicles": {"vehicle_id": 64, "vin": 64, "make": 100, "model": 100, "color": 50},
    "sales": {"sale_id": 64, "sale_channel": 50, "sale_status": 50, "payment_method": 50},
    "inventory": {"inventory_id": 64, "stock_status": 50},
    "payments": {"payment_id": 64, "sale_id": 64, "payment_method": 50, "status": 50, "transaction_reference": 100},
    "suppliers": {"supplier_id": 64, "supplier_name": 255, "contact_email": 255, "supplier_type": 50},
    "procurement": {"procurement_id": 64, "status": 50},
    "interactions": {"interaction_id": 64, "interaction_type": 50, "interaction_channel": 50, "outcome": 50, "employee_id": 64},
    "telemetry": {"telemetry_id": 64},
}
# Constraints of the star schema's tables.
TABLE_CHECKS = {
    "dim_date": {"quarter_range": "quarter BETWEEN 1 AND 4", "month_range": "month BETWEEN 1 AND 12", "day_range": "day BETWEEN 1 AND 31",
                 "day_of_week_range": "day_of_week BETWEEN 1 AND 7", "date_actual_not_null": "date_actual IS NOT NULL"},
    "dim_customer": {"expiry_after_effective": "expiry_date >= effective_date", "customer_id_not_null": "customer_id IS NOT NULL",
                     "effective_date_not_null": "effective_date IS NOT NULL"},
    "dim_vehicle": {"expiry_after_effective": "expiry_date >= effective_date", "vin_not_null": "vin IS NOT NULL",
                    "effective_date_not_null": "effective_date IS NOT NULL"},
    "fact_sales": {"sale_price_not_negative": "sale_price >= 0", "discount_not_negative": "discount_amount >= 0",
                   "final_price_not_negative": "final_price >= 0", "sale_id_not_null": "sale_id IS NOT NULL"},
    "fact_payments": {"payment_amount_not_negative": "payment_amount >= 0", "payment_id_not_null": "payment_id IS NOT NULL"},
    "fact_procurement": {"cost_price_not_negative": "cost_price >= 0", "procurement_id_not_null": "procurement_id IS NOT NULL"},
    "fact_inventory": {"quantity_not_negative": "quantity >= 0", "inventory_id_not_null": "inventory_id IS NOT NULL"},
    "fact_interactions": {"interaction_id_not_null": "interaction_id IS NOT NULL", "interaction_type_length": "length(interaction_type) <= 50"},
    "fact_telemetry": {"speed_range": "speed BETWEEN 0 AND 350", "fuel_level_range": "fuel_level BETWEEN 0 AND 100",
                       "engine_temperature_range": "engine_temperature BETWEEN -50 AND 250", "telemetry_id_not_null": "telemetry_id IS NOT NULL"},
}

# Run reporting.
SLA_SECONDS = 600
QUALITY_FAILURE_MARKER = "Data quality validation failed"
QUALITY_FAILURE_TITLE = "Data quality failure"
PIPELINE_FAILURE_TITLE = "Pipeline failure"

# Cell texts that count as missing in CSV files and workbooks.
NULL_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Stream: supported event types (one per dataset) and flush bounds.
STREAM_EVENT_TYPES = DATASETS
FLUSH_MAX_ROWS = 100
FLUSH_MAX_SECONDS = 300

# ---------------------------------------------------------------------------
# Staging targets (typed). Primary key first.
# ---------------------------------------------------------------------------

# Timestamps carry no zone, as in the source tables (TIMESTAMP without time zone).
S, TS, D = T.StringType(), T.TimestampNTZType(), T.DateType()
MONEY = T.DecimalType(18, 2)


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STAGING = {
    "customers": _st(("customer_id", S), ("first_name", S), ("last_name", S), ("email", S),
                     ("phone", S), ("address", S), ("city", S), ("state", S), ("zip_code", S),
                     ("date_of_birth", D), ("created_at", TS), ("is_dirty", T.BooleanType())),
    "dealers": _st(("dealer_id", S), ("dealer_name", S), ("contact_name", S), ("contact_email", S),
                   ("contact_phone", S), ("address", S), ("city", S), ("state", S), ("zip_code", S),
                   ("created_at", TS), ("is_dirty", T.BooleanType())),
    "vehicles": _st(("vehicle_id", S), ("vin", S), ("make", S), ("model", S), ("year", T.IntegerType()),
                    ("color", S), ("dealer_id", S), ("customer_id", S), ("purchase_date", TS),
                    ("is_dirty", T.BooleanType())),
    "sales": _st(("sale_id", S), ("vehicle_id", S), ("customer_id", S), ("dealer_id", S),
                 ("sale_date", TS), ("sale_price", MONEY), ("payment_method", S),
                 ("is_dirty", T.BooleanType())),
    "inventory": _st(("inventory_id", S), ("dealer_id", S), ("vehicle_id", S), ("stock_date", TS),
                     ("quantity", T.IntegerType()), ("is_dirty", T.BooleanType())),
    "payments": _st(("payment_id", S), ("sale_id", S), ("customer_id", S), ("payment_date", TS),
                    ("amount", MONEY), ("payment_method", S), ("status", S),
                    ("is_dirty", T.BooleanType())),
    "suppliers": _st(("supplier_id", S), ("supplier_name", S), ("contact_name", S),
                     ("contact_email", S), ("contact_phone", S), ("address", S), ("city", S),
                     ("state", S), ("zip_code", S), ("created_at", TS), ("is_dirty", T.BooleanType())),
    "procurement": _st(("procurement_id", S), ("supplier_id", S), ("dealer_id", S), ("item", S),
                       ("quantity", T.IntegerType()), ("procurement_date", TS), ("cost", MONEY),
                       ("status", S), ("is_dirty", T.BooleanType())),
    "interactions": _st(("interaction_id", S), ("customer_id", S), ("dealer_id", S),
                        ("interaction_type", S), ("interaction_date", TS), ("notes", S),
                        ("is_dirty", T.BooleanType())),
    "telemetry": _st(("telemetry_id", S), ("vehicle_id", S), ("timestamp", TS), ("sensor_type", S),
                     ("sensor_value", S), ("location", S), ("is_dirty", T.BooleanType())),
}

PRIMARY_KEYS = {name: [schema.fields[0].name] for name, schema in STAGING.items()}

# Columns that the landed files have, the staging tables lack and the facts need; the change log carries them.
LOGGED_EXTRAS = {"sales": [("discount_amount", MONEY)]}

# Columns of each dataset's stream messages besides its staging columns (message contract).
EVENT_EXTRAS = {
    "customers": ["name", "gender", "province"],
    "dealers": ["name", "province", "email", "phone"],
    "vehicles": ["engine_type", "transmission", "vehicle_status", "created_at"],
    "sales": ["discount_amount", "final_price", "sale_channel", "sale_status"],
    "inventory": ["stock_status", "last_updated"],
    "payments": ["transaction_reference"],
    "suppliers": ["supplier_type", "country"],
    "procurement": ["vehicle_id"],
    "interactions": ["interaction_channel", "outcome", "duration_minutes", "employee_id"],
    "telemetry": ["location_lat", "location_long"],
}

# Staging columns that have a categorical rule but are no part of the dataset's messages.
EVENT_OPTIONAL = {"sales": ("payment_method",)}


def event_columns(dataset: str) -> list[str]:
    """A dataset's stream columns, the same for every micro-batch."""
    own = [f.name for f in STAGING[dataset].fields if f.name != "is_dirty"]
    return own + [c for c in EVENT_EXTRAS[dataset] if c not in own]


# Superset of stream event fields (all values as text, JSON numbers accepted as text): every
# dataset's columns and every alias of one. Other keys of a message are kept as a map.
EVENT_FIELDS = sorted({"event_type"} | {c for d in DATASETS for c in event_columns(d)}
                      | {name for pairs in COLUMN_ALIASES.values() for pair in pairs for name in pair})
EVENT_SCHEMA = T.StructType([T.StructField(n, S, True) for n in EVENT_FIELDS])
