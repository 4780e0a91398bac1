"""Star schema: date, customer (SCD2), vehicle (SCD2), dealer, supplier; six facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.functions import keys as K
from finflow.functions import normalize as N
from finflow import schemas
from finflow.operators import lookups as L
from finflow.operators import scd
from finflow.operators.staging import first_per_key
from finflow.plans import feeds

# Total order used wherever one lineitem row per (l_orderkey, l_linenumber) is chosen.
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


# --- M1 ----------------------------------------------------------------------------------

def dim_date(*date_cols: F.Column, source: DataFrame) -> DataFrame:
    """One row per calendar day between the earliest and latest of ``date_cols``.

    The bounds are one aggregate row; the day list is bounded by the calendar, not by data.
    """
    mins = [F.min(F.to_date(c)) for c in date_cols]
    maxs = [F.max(F.to_date(c)) for c in date_cols]
    lo = F.least(*mins) if len(mins) > 1 else mins[0]
    hi = F.greatest(*maxs) if len(maxs) > 1 else maxs[0]
    days = source.agg(lo.alias("lo"), hi.alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_actual"))
    return calendar_attributes(days, "date_actual")


def calendar_attributes(days: DataFrame, col: str = "date_actual") -> DataFrame:
    d = F.col(col)
    dow = (F.weekday(d) + 1)  # ISO: Monday = 1 ... Sunday = 7
    return days.select(
        K.date_key(d).alias("date_key"), d.alias("date_actual"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), dow.alias("day_of_week"), (dow >= 6).alias("is_weekend"))


# --- M2 / M3 / M5 / M6 ---------------------------------------------------------------------

def dim_customer(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """SCD2 on (customer_id, effective_date): the customer's order-priority tier over time,
    with type-1 attributes (name, segment, nation) from the customer master."""
    hist = orders.select(F.col("o_custkey").alias("customer_id"), "o_orderdate", "o_orderkey",
                         F.col("o_orderpriority").alias("priority_tier"))
    versions = scd.scd2_from_history(hist, ["customer_id"], ["priority_tier"], "o_orderdate",
                                     tiebreak=["o_orderkey"])
    master = customer.select(
        F.col("c_custkey").alias("__ck"),
        N.first_token("c_name").alias("first_name"), N.rest_tokens("c_name").alias("last_name"),
        F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"))
    out = versions.join(master, F.col("customer_id") == F.col("__ck"), "left").drop("__ck")
    return out.withColumn("customer_key", K.surrogate_key("customer_id", "effective_date"))


def dim_vehicle(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """SCD2 on (vin, effective_date): a part's availability status over its shipments."""
    hist = lineitem.select(
        F.col("l_partkey").alias("vin"), "l_shipdate", "l_orderkey", "l_linenumber",
        F.when(F.col("l_linestatus") == "F", "Sold").otherwise("Available").alias("status"))
    versions = scd.scd2_from_history(hist, ["vin"], ["status"], "l_shipdate",
                                     tiebreak=["l_orderkey", "l_linenumber", "status"])
    master = part.select(F.col("p_partkey").alias("__pk"), F.col("p_brand").alias("make"),
                         F.col("p_name").alias("model"), F.col("p_type").alias("engine_type"))
    out = versions.join(master, F.col("vin") == F.col("__pk"), "left").drop("__pk")
    return out.withColumn("vehicle_key", K.surrogate_key("vin", "effective_date"))


def dim_dealer(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Type 1: the latest row per dealer (nation as dealer, region as its location)."""
    rows = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    src = rows.select(F.col("n_nationkey").alias("dealer_id"), F.col("n_name").alias("dealer_name"),
                      F.col("r_name").alias("location"))
    out = scd.latest_per_key(src, ["dealer_id"], ["dealer_name", "location"])
    return out.withColumn("dealer_key", K.surrogate_key("dealer_id"))


def dim_supplier(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Type 1 supplier dimension with its country."""
    src = L.lookup(supplier, nation, "s_nationkey", "n_nationkey", {"n_name": "country"})
    src = src.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
                     "country", F.col("s_acctbal").cast("decimal(18,2)").alias("account_balance"))
    out = scd.latest_per_key(src, ["supplier_id"], ["supplier_name", "country", "account_balance"])
    return out.withColumn("supplier_key", K.surrogate_key("supplier_id"))


# --- facts -----------------------------------------------------------------------------------

def sale_lines(lineitem: DataFrame) -> DataFrame:
    """Per sale: the vehicle of its first line and the discount over all its lines."""
    u = unique_lines(lineitem.select("l_orderkey", "l_linenumber", *LINE_ORDER))
    line = u.select(F.col("l_orderkey").alias("__sale"), "l_linenumber", "l_partkey",
                    (feeds.money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)").alias("__d"))
    return line.groupBy("__sale").agg(F.min_by("l_partkey", "l_linenumber").alias("vehicle_id"),
                                      F.sum("__d").cast("decimal(18,2)").alias("__discount"))


def fact_sales(orders: DataFrame, lineitem: DataFrame, dim_cust: DataFrame, vehicles: DataFrame,
               dealers: DataFrame) -> DataFrame:
    """M8: sale grain; customer and vehicle versions valid on the sale day (J8), dealer of
    the customer's nation (J7), date key; final price = price - discount (B15)."""
    s = feeds.sales(orders)
    s = s.withColumn("sale_date", F.to_date("sale_date"))
    s = s.join(sale_lines(lineitem), F.col("sale_id") == F.col("__sale"), "left").drop("__sale")
    s = L.point_in_time(s, dim_cust, "customer_id", "customer_id", "sale_date",
                        {"customer_key": "customer_key", "nation_id": "nation_id"})
    s = L.point_in_time(s, vehicles, "vehicle_id", "vin", "sale_date", {"vehicle_key": "vehicle_key"})
    s = L.lookup(s, dealers, "nation_id", "dealer_id", {"dealer_key": "dealer_key"})
    discount = F.coalesce("__discount", F.lit(0)).cast("decimal(18,2)")
    return s.select(
        K.surrogate_key("sale_id").alias("sales_key"), "sale_id", "sale_date",
        K.date_key("sale_date").alias("sale_date_key"), "customer_key", "vehicle_key", "dealer_key", "sale_price",
        discount.alias("discount_amount"), N.net_price("sale_price", discount).cast("decimal(18,2)").alias("final_price"),
        "sale_status")


def unique_lines(lineitem: DataFrame) -> DataFrame:
    """One lineitem per (l_orderkey, l_linenumber): the first on LINE_ORDER."""
    return first_per_key(lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)


def fact_payments(lineitem: DataFrame, sales: DataFrame) -> DataFrame:
    """M9: one row per payment id with its date key and the key of its sale, null where the
    sale is unknown (``sales``: sale_id, sales_key of the sales fact)."""
    p = feeds.payment_facts(unique_lines(lineitem))
    p = L.lookup(p, sales.select(F.col("sale_id").alias("__known"), "sales_key"), "sale_id", "__known", {"sales_key": "sales_key"})
    status = N.recode(F.when(F.col("l_returnflag") == "R", "refunded")
                       .when(F.col("l_returnflag") == "A", "completed").otherwise("pending"),
                      schemas.PAYMENT_STATUS_MAP)
    return p.select(
        K.surrogate_key("payment_id").alias("payment_key"), "payment_id", "sale_id", "sales_key",
        F.to_date("payment_date").alias("payment_date"),
        K.date_key("payment_date").alias("payment_date_key"), "payment_amount",
        status.alias("payment_status"))


def fact_procurement(lineitem: DataFrame, suppliers: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Procurement lines with supplier (type 1) and vehicle version on the day (SCD2)."""
    p = feeds.payment_facts(unique_lines(lineitem))
    status = N.recode(F.when(F.col("l_returnflag") == "R", "returned")
                       .when(F.col("l_linestatus") == "O", "pending").otherwise("completed"),
                      schemas.PROCUREMENT_STATUS_MAP)
    p = p.select("payment_id", F.to_date("payment_date").alias("procurement_date"), "l_suppkey", "l_partkey", "payment_amount", status.alias("status"))
    # The versions first: the supplier's columns need not travel to them.
    p = L.point_in_time(p, vehicles, "l_partkey", "vin", "procurement_date",
                        {"vehicle_key": "vehicle_key", "effective_date": "vehicle_effective_date"})
    p = L.lookup(p, suppliers, "l_suppkey", "supplier_id",
                 {"supplier_key": "supplier_key", "country": "supplier_country"})
    return p.select(
        K.surrogate_key("payment_id").alias("procurement_key"), F.col("payment_id").alias("procurement_id"), "procurement_date",
        K.date_key("procurement_date").alias("procurement_date_key"),
        F.col("l_suppkey").alias("supplier_id"), "supplier_key", "supplier_country",
        F.col("l_partkey").alias("vehicle_id"), "vehicle_key", "vehicle_effective_date",
        F.col("payment_amount").alias("cost_price"), "status")


def fact_inventory(part: DataFrame, lineitem: DataFrame, vehicles: DataFrame, dealers: DataFrame) -> DataFrame:
    """Stock per vehicle against its current version, dated by its latest movement and
    held by a dealer (an illustrative assignment: the part number over the 25 nations)."""
    moved = lineitem.groupBy(F.col("l_partkey").alias("__part")).agg(F.max(F.to_date("l_shipdate")).alias("inventory_date"))
    inv = part.join(moved, F.col("p_partkey") == F.col("__part"), "left").drop("__part")
    inv = inv.withColumn("dealer_id", F.pmod(F.col("p_partkey"), F.lit(25)))
    cur = vehicles.filter(F.col("is_current"))
    inv = L.lookup(inv, cur, "p_partkey", "vin", {"vehicle_key": "vehicle_key"})
    inv = L.lookup(inv, dealers.select(F.col("dealer_id").alias("__dealer"), "dealer_key"), "dealer_id", "__dealer",
                   {"dealer_key": "dealer_key"})
    qty = F.col("p_size")
    stock = (F.when(qty > 25, "In Stock").when(qty > 5, "Coming Soon").otherwise("Out of Stock"))
    return inv.select(K.surrogate_key("p_partkey").alias("inventory_key"), F.col("p_partkey").alias("inventory_id"), "inventory_date",
                      K.date_key("inventory_date").alias("inventory_date_key"), "vehicle_key", "dealer_key",
                      qty.alias("quantity"), stock.alias("stock_status"))


def fact_interactions(events: DataFrame, dim_cust: DataFrame, dealers: DataFrame) -> DataFrame:
    """Interactions with the customer version valid on the interaction day and the
    dealer of that customer's nation."""
    e = events.select(F.col("event_id").alias("interaction_id"),
                      F.to_date("ts").alias("interaction_date"),
                      F.col("user_id").alias("customer_id"),
                      F.col("event_type").alias("interaction_type"))
    e = L.point_in_time(e, dim_cust, "customer_id", "customer_id", "interaction_date",
                        {"customer_key": "customer_key", "nation_id": "nation_id"})
    e = L.lookup(e, dealers, "nation_id", "dealer_id", {"dealer_key": "dealer_key"})
    return e.select(K.surrogate_key("interaction_id").alias("interaction_key"), "interaction_id", "interaction_date",
                    K.date_key("interaction_date").alias("interaction_date_key"),
                    "customer_key", "dealer_key", "interaction_type")


# Event types that stand for the sensors of the telemetry fact (an illustrative assignment).
SENSOR_EVENTS = {"speed": "click", "fuel_level": "view", "engine_temperature": "purchase"}


def fact_telemetry(events: DataFrame, vehicles: DataFrame) -> DataFrame:
    """One row per reading (event grain) with the vehicle version of its day, its
    sensor's column, other sensors by type and value, and its position."""
    e = events.select(F.col("event_id").alias("telemetry_id"), F.col("user_id").alias("vehicle_id"),
                      F.col("ts").alias("telemetry_timestamp"), F.col("event_type").alias("__type"),
                      F.col("value").alias("__value"), feeds.k_of().alias("__k"))
    e = L.point_in_time(e, vehicles, "vehicle_id", "vin", "telemetry_timestamp", {"vehicle_key": "vehicle_key"})
    other = ~F.coalesce(F.col("__type").isin(list(SENSOR_EVENTS.values())), F.lit(False))
    place = lambda at: (F.lit(at).cast("decimal(9,6)") + (F.col("__k").cast("decimal(9,6)") / 1000).cast("decimal(9,6)")).cast("decimal(9,6)")
    return e.select(
        K.surrogate_key("telemetry_id").alias("telemetry_key"), "telemetry_id", "vehicle_key", "telemetry_timestamp",
        K.date_key("telemetry_timestamp").alias("telemetry_date_key"),
        *[F.when(F.col("__type") == t, F.round(F.col("__value").cast("decimal(18,6)")).cast("int")).alias(s) for s, t in SENSOR_EVENTS.items()],
        F.when(other, F.col("__type")).alias("other_sensor"), F.when(other, F.col("__value")).alias("other_value"),
        place("43.6").alias("location_lat"), place("-79.5").alias("location_long"))
