"""Fixed schemas, keys and constraints of the six procure-to-pay tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STR, INT, BOOL, TS, DATE = (
    T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampType(), T.DateType(),
)
MONEY, PCT = T.DecimalType(15, 2), T.DecimalType(6, 2)


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols.items()])


SCHEMAS: dict[str, T.StructType] = {
    "users": _schema(
        user_id=STR, user_name=STR, role=STR, department=STR, access_level=INT,
        last_login_date=TS, is_active=BOOL,
    ),
    "vendors": _schema(
        vendor_id=STR, vendor_name=STR, vendor_creation_date=DATE, vendor_category=STR,
        bank_account_number=STR, registered_address=STR, contact_email=STR,
        payment_method=STR, is_active=BOOL, created_by_user=STR, is_ghost_vendor=BOOL,
        anomaly_flag=INT,
    ),
    "budget": _schema(
        cost_centre=STR, department=STR, budget_period=STR, approved_budget=MONEY,
        committed_amount=MONEY, actual_spend=MONEY, remaining_budget=MONEY,
        budget_utilisation_pct=PCT, is_overrun=BOOL, anomaly_flag=INT,
    ),
    "purchase_orders": _schema(
        po_number=STR, po_date=TS, vendor_id=STR, vendor_name=STR, item_description=STR,
        quantity_ordered=INT, unit_price=MONEY, total_po_value=MONEY, department=STR,
        cost_centre=STR, budget_code=STR, approval_status=STR, approver_id=STR,
        plant_location=STR, is_split_po=BOOL, anomaly_flag=INT,
    ),
    "goods_receipts": _schema(
        gr_number=STR, gr_date=TS, po_number=STR, vendor_id=STR, quantity_received=INT,
        actual_unit_price=MONEY, receiving_location=STR, received_by=STR, anomaly_flag=INT,
    ),
    "invoices": _schema(
        invoice_number=STR, invoice_date=TS, vendor_invoice_number=STR, vendor_id=STR,
        po_number=STR, gr_number=STR, invoice_amount=MONEY, tax_amount=MONEY,
        total_amount=MONEY, payment_terms_days=INT, due_date=TS, payment_date=TS,
        payment_amount=MONEY, invoice_status=STR, processed_by=STR, approved_by=STR,
        cost_centre=STR, is_duplicate=BOOL, is_near_duplicate=BOOL, is_match_failure=BOOL,
        is_maverick=BOOL, is_after_hours=BOOL, is_round_number=BOOL,
        is_ghost_vendor_inv=BOOL, anomaly_flag=INT, anomaly_type=STR,
    ),
}

# Parents before children, so that a load never refers to a missing row.
LOAD_ORDER = ("users", "vendors", "budget", "purchase_orders", "goods_receipts", "invoices")

UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "users": ("user_id",),
    "vendors": ("vendor_id",),
    "budget": ("cost_centre", "budget_period"),
    "purchase_orders": ("po_number",),
    "goods_receipts": ("gr_number",),
    "invoices": ("invoice_number",),
}

NOT_NULL: dict[str, tuple[str, ...]] = {
    "users": ("user_id", "user_name", "role"),
    "vendors": ("vendor_id", "vendor_name", "vendor_creation_date"),
    "budget": ("cost_centre",),
    "purchase_orders": ("po_number", "po_date"),
    "goods_receipts": ("gr_number", "gr_date"),
    "invoices": ("invoice_number", "invoice_date"),
}

CHECKS: dict[str, dict[str, str]] = {
    "users": {"access_level_1_to_4": "access_level BETWEEN 1 AND 4"},
}

DEFAULTS: dict[str, dict[str, object]] = {
    "users": {"is_active": True},
    "vendors": {"is_active": True, "is_ghost_vendor": False, "anomaly_flag": 0},
    "budget": {"is_overrun": False, "anomaly_flag": 0},
    "purchase_orders": {"is_split_po": False, "anomaly_flag": 0},
    "goods_receipts": {"anomaly_flag": 0},
    "invoices": {
        "is_duplicate": False, "is_near_duplicate": False, "is_match_failure": False,
        "is_maverick": False, "is_after_hours": False, "is_round_number": False,
        "is_ghost_vendor_inv": False, "anomaly_flag": 0, "anomaly_type": "Normal",
    },
}

FOREIGN_KEYS = (
    ("purchase_orders", "vendor_id", "vendors", "vendor_id"),
    ("goods_receipts", "po_number", "purchase_orders", "po_number"),
    ("invoices", "po_number", "purchase_orders", "po_number"),
    ("invoices", "vendor_id", "vendors", "vendor_id"),
    ("invoices", "gr_number", "goods_receipts", "gr_number"),
)


@dataclass(frozen=True)
class ErpTables:
    users: DataFrame
    vendors: DataFrame
    budget: DataFrame
    purchase_orders: DataFrame
    goods_receipts: DataFrame
    invoices: DataFrame

    def items(self):
        return [(name, getattr(self, name)) for name in LOAD_ORDER]
