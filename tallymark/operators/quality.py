"""Data-quality checks. Counting checks return (check, subject, measure,
value) rows with a bigint value, listings return plain rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import ANOMALY_FLAGS, DEFAULT, AuditConfig
from tallymark.functions.expressions import days_floor, deviates, deviation_pct, is_after_hours
from tallymark.functions.joins import left_lookup
from tallymark.sources.schemas import CHECKS, FOREIGN_KEYS, NOT_NULL, UNIQUE_KEYS, ErpTables


def _long(row: DataFrame, check: str, subject: str, measures: list[str]) -> DataFrame:
    """A one-row aggregate as long rows."""
    entries = [
        F.struct(
            F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.lit(m).alias("measure"),
            F.col(f"`{m}`").cast("bigint").alias("value"),
        )
        for m in measures
    ]
    return row.select(F.inline(F.array(*entries)))


def _measure(df: DataFrame, check: str, subject: str, aggs: dict[str, Column]) -> DataFrame:
    return _long(df.agg(*[c.alias(n) for n, c in aggs.items()]), check, subject, list(aggs))


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def shape_and_nulls(tables: ErpTables) -> DataFrame:
    """Rows, columns and NULLs per column with their share; one pass per table."""
    parts = []
    for name, df in tables.items():
        aggs = {"_rows": F.count(F.lit(1)), "_columns": F.lit(len(df.columns))}
        aggs |= {c: F.count_if(F.col(c).isNull()) for c in df.columns}
        row = df.agg(*[c.alias(n) for n, c in aggs.items()])
        total = F.col("_rows")
        entries = [
            F.struct(
                F.lit(name).alias("table"), F.lit(m).alias("measure"),
                F.col(m).cast("bigint").alias("value"),
                (F.lit(None).cast("double") if m.startswith("_") else F.try_divide(F.col(m) * 100.0, total)).alias("pct"),
            )
            for m in aggs
        ]
        parts.append(row.select(F.inline(F.array(*entries))))
    return _stack(parts)


def row_counts(tables: ErpTables) -> DataFrame:
    """Rows per table in load order."""
    return _stack(
        [
            df.agg(F.lit(i + 1).alias("load_order"), F.lit(name).alias("table"), F.count(F.lit(1)).alias("n"))
            for i, (name, df) in enumerate(tables.items())
        ]
    )


def _violations(name: str) -> dict[str, Column]:
    """What breaks a NOT NULL or CHECK constraint of a table."""
    broken = {f"not_null.{c}": F.col(c).isNull() for c in NOT_NULL[name]}
    return broken | {f"check.{n}": ~F.expr(sql) for n, sql in CHECKS.get(name, {}).items()}


def integrity(tables: ErpTables) -> DataFrame:
    """Duplicate keys, orphans, and violations of NOT NULL, CHECK and UNIQUE, as
    (check, subject, measure, value).

    One scan a table gives a stream of tagged keys: own keys, non-NULL foreign keys, and a row
    per violated constraint. Equal ones combine before the only shuffle, so a hot foreign key
    costs a row per task; a grouped pass then settles all constraints."""
    names = [name for name, _ in tables.items()]
    tags = [(name, None) for name in names] + [(child, col) for child, col, _, _ in FOREIGN_KEYS]
    violated = len(tags)
    parts = []
    for name, df in tables.items():
        keys = UNIQUE_KEYS[name]
        own = F.col(keys[0]).cast("string") if len(keys) == 1 else F.to_json(F.struct(*keys))
        entries = [_tagged(names.index(name), own, tags.index((name, None)))]
        for child, col, parent, _ in FOREIGN_KEYS:
            if child == name:
                entries.append(F.when(F.col(col).isNotNull(), _tagged(names.index(parent), F.col(col).cast("string"), tags.index((child, col)))))
        entries += [F.when(broken, _tagged(-1, F.lit(f"{name}/{m}"), violated)) for m, broken in _violations(name).items()]
        parts.append(df.select(F.inline(F.array_compact(F.array(*entries)))))
    settled = _stack(parts).groupBy("domain", "key").agg(
        *[F.count_if(F.col("tag") == i).alias(f"t{i}") for i in range(violated + 1)]
    )

    def total(where: Column, count: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, count)), F.lit(0))

    measures: list[tuple[str, str, str, Column]] = []
    surplus = {
        name: total(F.col("domain") == i, F.greatest(F.col(f"t{tags.index((name, None))}") - 1, F.lit(0))) for i, name in enumerate(names)
    }
    for name, keys in UNIQUE_KEYS.items():
        if len(keys) == 1:
            measures.append(("duplicate_key", f"{name}.{keys[0]}", "duplicates", surplus[name]))
    for child, col, parent, _ in FOREIGN_KEYS:
        unknown = (F.col("domain") == names.index(parent)) & (F.col(f"t{tags.index((parent, None))}") == 0)
        measures.append(("orphan", f"{child}.{col}", "orphans", total(unknown, F.col(f"t{tags.index((child, col))}"))))
    for name in names:
        for m in _violations(name):
            measures.append(("constraint", name, m, total((F.col("domain") == -1) & (F.col("key") == f"{name}/{m}"), F.col(f"t{violated}"))))
        measures.append(("constraint", name, "unique." + ",".join(UNIQUE_KEYS[name]), surplus[name]))
    row = settled.agg(*[value.cast("bigint").alias(f"m{i}") for i, (*_, value) in enumerate(measures)])
    entries = [
        F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"), F.lit(m).alias("measure"), F.col(f"m{i}").alias("value"))
        for i, (check, subject, m, _) in enumerate(measures)
    ]
    return row.select(F.inline(F.array(*entries)))


def _tagged(domain: int, key: Column, tag: int) -> Column:
    return F.struct(F.lit(domain).alias("domain"), key.alias("key"), F.lit(tag).alias("tag"))


def duplicate_keys(tables: ErpTables, found: DataFrame | None = None) -> DataFrame:
    """Surplus rows per single-column key. `found` is `integrity` where known already."""
    return (integrity(tables) if found is None else found).filter(F.col("check") == "duplicate_key")


def orphans(tables: ErpTables, found: DataFrame | None = None) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent."""
    return (integrity(tables) if found is None else found).filter(F.col("check") == "orphan")


def constraint_violations(tables: ErpTables, found: DataFrame | None = None) -> DataFrame:
    """Violations of NOT NULL, CHECK and UNIQUE constraints."""
    return (integrity(tables) if found is None else found).filter(F.col("check") == "constraint")


def labelled_duplicates(invoices: DataFrame) -> DataFrame:
    """Every labelled duplicate against the number of rows with its vendor and
    reference: labelled rows, and those whose reference occurs only once."""
    keys = ["vendor_id", "vendor_invoice_number"]
    counts = invoices.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_duplicate").alias("labelled")
    )
    return _measure(
        counts, "labelled_duplicates", "invoices",
        {
            "labelled": F.coalesce(F.sum("labelled"), F.lit(0)),
            "reference_seen_once": F.coalesce(F.sum(F.when(F.col("n") < 2, F.col("labelled"))), F.lit(0)),
        },
    )


def near_duplicate_labels(invoices: DataFrame, limit: int | None = None) -> DataFrame:
    """Listing of the labelled near-duplicates, with their total count."""
    labelled = invoices.filter("is_near_duplicate")
    total = labelled.agg(F.count(F.lit(1)).alias("n")).scalar()
    listed = labelled.select("invoice_number", "vendor_id", "invoice_amount", total.alias("labelled_total"))
    return listed if limit is None else listed.orderBy("invoice_number").limit(limit)


def split_labels(purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    t = F.lit(cfg.approval_threshold)
    labelled = purchase_orders.filter("is_split_po")
    groups = labelled.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_po_value").alias("total"),
        F.bool_and(F.col("total_po_value") < t).alias("below"),
    )
    return _measure(
        groups, "split_labels", "purchase_orders",
        {
            "labelled": F.coalesce(F.sum("n"), F.lit(0)),
            "all_below_threshold": F.coalesce(F.bool_and("below"), F.lit(True)).cast("int"),
            "vendor_groups_above": F.count_if(F.col("total") > t),
        },
    )


def split_label_groups(purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT, limit: int | None = None) -> DataFrame:
    groups = (
        purchase_orders.filter("is_split_po")
        .groupBy("vendor_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_po_value").alias("total"))
        .filter(F.col("total") > F.lit(cfg.approval_threshold))
    )
    return groups if limit is None else groups.orderBy("vendor_id").limit(limit)


def match_labels(
    invoices: DataFrame, purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT
) -> DataFrame:
    """One row: labelled rows, rows truly outside the tolerance, range, status."""
    rows = left_lookup(
        invoices.filter("is_match_failure"), purchase_orders.select("po_number", "total_po_value"), "po_number", "invoice_number"
    )
    a, b = F.col("invoice_amount"), F.col("total_po_value")
    return rows.agg(
        F.count(F.lit(1)).alias("labelled"),
        F.count_if(deviates(a, b, cfg.match_tolerance)).alias("outside_tolerance"),
        F.min(deviation_pct(a, b)).alias("min_deviation_pct"),
        F.max(deviation_pct(a, b)).alias("max_deviation_pct"),
        F.bool_and(F.col("invoice_status") == "Blocked").alias("all_blocked"),
    )


def maverick_labels(invoices: DataFrame) -> DataFrame:
    return invoices.filter("is_maverick").agg(
        F.count(F.lit(1)).alias("labelled"),
        F.bool_and(F.col("po_number").isNull()).alias("all_without_po"),
        F.bool_and(F.col("gr_number").isNull()).alias("all_without_gr"),
    )


def after_hours_labels(invoices: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    return invoices.filter("is_after_hours").agg(
        F.count(F.lit(1)).alias("labelled"),
        F.count_if(is_after_hours(F.col("invoice_date"), cfg)).alias("outside_hours"),
    )


def round_labels(invoices: DataFrame, limit: int | None = None) -> DataFrame:
    labelled = invoices.filter("is_round_number")
    total = labelled.agg(F.count(F.lit(1)).alias("n")).scalar()
    listed = labelled.select("invoice_number", "invoice_amount", total.alias("labelled_total"))
    return listed if limit is None else listed.orderBy("invoice_number").limit(limit)


def ghost_labels(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    ghosts = vendors.agg(F.count_if("is_ghost_vendor").alias("n")).scalar()
    rows = invoices.filter("is_ghost_vendor_inv").join(
        vendors.select("vendor_id", "vendor_creation_date"), "vendor_id", "left"
    )
    days = days_floor(F.col("invoice_date"), F.col("vendor_creation_date"))
    return rows.agg(
        F.count(F.lit(1)).alias("labelled_invoices"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
        F.bool_and(F.col("payment_terms_days") == 15).alias("all_15_day_terms"),
    ).withColumn("ghost_vendors", ghosts)


def overrun_rows(budget: DataFrame) -> DataFrame:
    return budget.agg(
        F.count_if(F.col("actual_spend") > F.col("approved_budget")).alias("overrun_rows")
    )


def flag_consistency(invoices: DataFrame) -> DataFrame:
    """Sub-flags per anomalous row (0, 1, more) and normal rows that have any."""
    flags = reduce(lambda a, b: a + b, [F.coalesce(F.col(f), F.lit(False)).cast("int") for f in ANOMALY_FLAGS])
    rows = invoices.select("anomaly_flag", flags.alias("n"))
    odd = F.col("anomaly_flag") == 1
    return rows.agg(
        F.count_if(odd).alias("anomalous"),
        F.count_if(odd & (F.col("n") == 1)).alias("one_flag"),
        F.count_if(odd & (F.col("n") == 0)).alias("no_flag"),
        F.count_if(odd & (F.col("n") > 1)).alias("several_flags"),
        F.count_if((F.col("anomaly_flag") == 0) & (F.col("n") > 0)).alias("normal_with_flag"),
    )
