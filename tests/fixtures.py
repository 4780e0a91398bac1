"""Literal landed files with the dirt recipes of FIXTURES.md section 3."""

from __future__ import annotations

import json
import os

from finflow.plans.feeds import workbook as write_xlsx_bytes

SALES_CSV = """sale_id,sale_date,customer_id,vehicle_id,dealer_id,sale_price,discount_amount,final_price,sale_channel,sale_status,created_at
S1,2026-02-01,C1,V1,D1,25000.00,500,24500,Online,Completed,2026-02-01 10:00:00
S2,31-02-2025,C2,V2,D1,-5000,0,-5000,Online,Pending,2026-02-01 10:00:00
S3,15-01-2026,C3,V3,D2,abc,0,0,Phone,Completed,2026-02-01 10:00:00
S1,2026-02-02,C9,V9,D9,1.00,0,1,Online,Completed,2026-02-01 10:00:00
S4,2026-02-03, C4 ,V4,D2,  30000.50 ,0,30000.50,Dealership, Pending ,2026-02-01 10:00:00
"""

SALES_DUP_CSV = """sale_id,sale_date,customer_id,vehicle_id,dealer_id,sale_price,sale_channel,sale_status
S7,2026-02-05,C7,V7,D1,100.00,Online,Completed
S7,2026-02-05,C7,V7,D1,100.00,Online,Completed
"""

SALES_MISSING_CSV = """customer_id,vehicle_id,sale_price
C1,V1,10.00
"""

PAYMENTS_CSV = """transaction_id,sale_id,transaction_date,payment_amount,payment_method,payment_status,transaction_reference
P1,S1,2026-02-01,24500.00,Credit Card,completed,T1
P2,S2,2026-02-01,99999999,Cash,PAID,T2
P3,S4,2026-02-03,100.00,Check,Cancelled,T3
"""

INTERACTIONS = [
    {"interaction_id": "I1", "customer_id": "C1", "type": "Phone", "timestamp": "2026-02-01 09:00:00",
     "created_date": "2026-01-01", "notes": " hello ", "meta": {"agent": {"id": 7}, "tags": ["a", "b"]}},
    {"interaction_id": "I2", "customer_id": None, "type": "Fax", "timestamp": "2026-02-01 09:05:00"},
]

CUSTOMERS_XLSX_HEADER = ["customer_id", "name", "email", "phone", "date_of_birth", "gender", "province", "status"]
CUSTOMERS_XLSX_ROWS = [
    ["C1", "Ada Lovelace", " ADA@Example.COM ", "+27 11 555 0101", "1990-05-01", "F", "ON", "Active"],
    ["C2", "Plato", "not-an-email", "value??", "01/02/1980", "M", "ON", "Active"],
    ["C3", "Juan Carlos Perez", "juan@x.org", None, "31-02-2025", "M", "Gauteng", "Active"],
    ["C4", None, None, None, None, None, None, None],
]


def write_landing(root: str) -> dict[str, str]:
    paths = {}

    def put(rel: str, data: bytes | str) -> None:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data.encode() if isinstance(data, str) else data)
        paths[rel] = p

    put("erp/sales_2026_20260226_102345.csv", SALES_CSV)
    put("erp/sales_dup_2026_20260226_102346.csv", SALES_DUP_CSV)
    put("erp/sales_2026_20260227_000000.CSV", SALES_MISSING_CSV)
    put("finance/erp_finance_2026_20260226.csv", PAYMENTS_CSV)
    put("crm/customer_interactions_2026_20260226.json", json.dumps(INTERACTIONS))
    put("crm/crm_customers_2026_20260226.xlsx", write_xlsx_bytes(CUSTOMERS_XLSX_HEADER, CUSTOMERS_XLSX_ROWS))
    put("misc/notes_2026.txt", "hello")
    put("misc/mystery_table_2026.csv", "a,b\n1,2\n")
    put("erp/empty_sales_2026.csv", "sale_id,sale_date\n")
    return paths
