"""Small hand-written tables; columns not given are NULL or their default."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from tallymark.sources.schemas import DEFAULTS, SCHEMAS


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def table(spark, name: str, rows: list[dict]):
    schema = SCHEMAS[name]
    money = {f.name for f in schema.fields if f.dataType.typeName() == "decimal"}
    data = []
    for row in rows:
        full = {**dict.fromkeys(schema.names), **DEFAULTS.get(name, {}), **row}
        data.append(
            tuple(
                Decimal(str(full[c])) if c in money and full[c] is not None else full[c]
                for c in schema.names
            )
        )
    return spark.createDataFrame(data, schema)


def invoice(num: str, when: str, amount, vendor="A", ref=None, **more) -> dict:
    return {
        "invoice_number": num, "invoice_date": ts(when), "invoice_amount": amount,
        "vendor_id": vendor, "vendor_invoice_number": ref, **more,
    }


def keys(df, *cols: str) -> set:
    cols = cols or ("invoice_number",)
    rows = [tuple(r) if len(cols) > 1 else r[0] for r in df.select(*cols).collect()]
    assert len(rows) == len(set(rows)), rows
    return set(rows)
