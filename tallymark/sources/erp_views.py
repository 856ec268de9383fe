"""The six procure-to-pay tables as deterministic views over the star schema.

All choices are functions of the order key, so any engine that follows the
same rules gets the same rows. Money is kept in whole cents until the final
cast. Every view is one pass over its base table; an order fans out into the
invoices it causes with one `explode` of at most eight codes.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.expressions import plus_days, plus_hours
from tallymark.functions.ordering import new_path
from tallymark.sources.loading import open_tables
from tallymark.sources.schemas import SCHEMAS, ErpTables

NORMAL, DUPLICATE, NEAR_DUPLICATE, MATCH, MAVERICK, AFTER_HOURS, ROUND, GHOST = range(8)

# Label names by code.
ANOMALY_TYPES = (
    "Normal",
    "Duplicate Invoice",
    "Near-Duplicate Invoice",
    "Three-Way Match Failure",
    "Maverick Buying",
    "After-Hours Transaction",
    "Round Number",
    "Ghost Vendor Invoice",
)


def _pad(value: Column, width: int) -> Column:
    """Zero-pad without ever cutting a longer value."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def _code(prefix: str, value: Column, width: int = 0) -> Column:
    return F.concat(F.lit(prefix), _pad(value, width) if width else value.cast("string"))


def _cents(value: Column) -> Column:
    return (value.cast("decimal(15,0)") * F.lit(Decimal("0.01"))).cast("decimal(15,2)")


def _per_mille(value: Column, factor: Column) -> Column:
    """floor(value * factor / 1000) on non-negative whole numbers."""
    return F.call_function("div", value * factor, F.lit(1000))


def _as(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[table].fields])


def _spread(df: DataFrame) -> DataFrame:
    """Give a source with fewer splits than cores one split per core. A source
    with more splits, as any large one, passes unchanged and unshuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_suppliers = (
        spark.read.parquet(f"{sf_dir}/supplier.parquet").agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    k = F.col("k")
    source = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"
    )
    return (
        _spread(source)
        .select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("cust"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("c"),
            F.col("o_orderdate").cast("timestamp").alias("day"),
            (F.col("o_orderstatus") != "P").alias("approved"),
        )
        .withColumn("vendor_no", F.col("cust") % n_suppliers)
        .withColumn("vendor_id", _code("VEND", F.col("vendor_no"), 5))
        .withColumn("user_id", _code("U", F.col("cust"), 5))
        .withColumn("cc", k % 20 + 1)
        .withColumn("cost_centre", _code("CC", F.col("cc"), 3))
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _as(
        spark.read.parquet(f"{sf_dir}/customer.parquet").select(
            _code("U", k, 5).alias("user_id"),
            F.col("c_name").alias("user_name"),
            F.col("c_mktsegment").alias("role"),
            _code("DEPT", k % 10).alias("department"),
            (k % 4 + 1).alias("access_level"),
            plus_days(F.lit("2001-08-01").cast("timestamp"), k % 30).alias("last_login_date"),
            (k % 17 != 0).alias("is_active"),
        ),
        "users",
    )


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    regular = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        _code("VEND", k, 5).alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.date_add(F.lit("1994-06-01").cast("date"), (k * 7 % 365).cast("int")).alias("vendor_creation_date"),
        _code("CAT", F.col("s_nationkey") % 10).alias("vendor_category"),
        _code("ACC", k, 8).alias("bank_account_number"),
        _code("ADDR", k).alias("registered_address"),
        F.concat(F.lit("ap"), k.cast("string"), F.lit("@vendor.example")).alias("contact_email"),
        F.when(k % 2 == 0, "Transfer").otherwise("Cheque").alias("payment_method"),
        F.lit(True).alias("is_active"),
        _code("U", k, 5).alias("created_by_user"),
        F.lit(False).alias("is_ghost_vendor"),
        F.lit(0).alias("anomaly_flag"),
    )
    g = F.col("g")
    ghosts = (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .filter(F.col("o_orderkey") % 269 == 7)
        .select((F.col("o_orderkey") % 15).alias("g"))
        .distinct()
        .select(
            _code("GHOST", g).alias("vendor_id"),
            _code("Ghost Trading ", g).alias("vendor_name"),
            F.lit("2001-06-15").cast("date").alias("vendor_creation_date"),
            _code("CAT", g % 10).alias("vendor_category"),
            _code("ACC9", g, 8).alias("bank_account_number"),
            F.lit(None).cast("string").alias("registered_address"),
            F.concat(F.lit("g"), g.cast("string"), F.lit("@mail.example")).alias("contact_email"),
            F.lit("Transfer").alias("payment_method"),
            F.lit(True).alias("is_active"),
            _code("U", g, 5).alias("created_by_user"),
            F.lit(True).alias("is_ghost_vendor"),
            F.lit(1).alias("anomaly_flag"),
        )
    )
    return _as(regular.unionByName(ghosts), "vendors")


def budget(orders: DataFrame) -> DataFrame:
    cc, yr = F.col("cc"), F.col("yr")
    per_year = (
        orders
        .groupBy("cc", "cost_centre", F.year("day").alias("yr"))
        .agg(F.sum("c").alias("approved"))
    )
    overrun = (cc * 7 + yr) % 5 == 0
    pm = F.when(overrun, (cc * 13 + yr) % 300 + 1050).otherwise((cc * 31 + yr) % 700 + 300)
    sized = per_year.withColumn("pm", pm).withColumn(
        "actual", _per_mille(F.col("approved"), F.col("pm"))
    )
    return _as(
        sized.select(
            "cost_centre",
            _code("DEPT", cc % 10).alias("department"),
            yr.cast("string").alias("budget_period"),
            _cents(F.col("approved")).alias("approved_budget"),
            _cents(_per_mille(F.col("actual"), F.lit(1100))).alias("committed_amount"),
            _cents(F.col("actual")).alias("actual_spend"),
            _cents(F.col("approved") - F.col("actual")).alias("remaining_budget"),
            (F.col("pm").cast("decimal(10,1)") / 10).alias("budget_utilisation_pct"),
            (F.col("pm") > 1000).alias("is_overrun"),
            F.when(F.col("pm") > 1000, 1).otherwise(0).alias("anomaly_flag"),
        ),
        "budget",
    )


def purchase_orders(orders: DataFrame) -> DataFrame:
    k, c = F.col("k"), F.col("c")
    quantity = k % 40 + 1
    split = F.col("approved") & (c < 10_000_000) & (k % 37 == 5)
    return _as(
        orders.select(
            _code("PO", k).alias("po_number"),
            plus_hours(F.col("day"), k % 11 + 8).alias("po_date"),
            "vendor_id",
            _code("Supplier#", F.col("vendor_no"), 9).alias("vendor_name"),
            _code("ITEM", k % 50).alias("item_description"),
            quantity.alias("quantity_ordered"),
            _cents(F.call_function("div", c, quantity)).alias("unit_price"),
            _cents(c).alias("total_po_value"),
            _code("DEPT", F.col("cc") % 10).alias("department"),
            "cost_centre",
            _code("B", F.col("cc"), 3).alias("budget_code"),
            F.when(F.col("approved"), "Approved").otherwise("Pending").alias("approval_status"),
            F.col("user_id").alias("approver_id"),
            _code("PLANT", k % 5).alias("plant_location"),
            split.alias("is_split_po"),
            F.when(split, 1).otherwise(0).alias("anomaly_flag"),
        ),
        "purchase_orders",
    )


def goods_receipts(orders: DataFrame) -> DataFrame:
    k, c = F.col("k"), F.col("c")
    quantity = k % 40 + 1
    return _as(
        orders
        .filter(F.col("approved") & (k % 20 >= 3))
        .select(
            _code("GR", k).alias("gr_number"),
            plus_days(F.col("day"), k % 28 + 3).alias("gr_date"),
            _code("PO", k).alias("po_number"),
            "vendor_id",
            quantity.alias("quantity_received"),
            _cents(F.call_function("div", c, quantity)).alias("actual_unit_price"),
            _code("PLANT", k % 5).alias("receiving_location"),
            F.col("user_id").alias("received_by"),
            F.lit(0).alias("anomaly_flag"),
        ),
        "goods_receipts",
    )


def _by_kind(kind: Column, choices: dict[int, Column], default: Column) -> Column:
    (code, value), *rest = choices.items()
    chain = F.when(kind == code, value)
    for code, value in rest:
        chain = chain.when(kind == code, value)
    return chain.otherwise(default)


def invoices(orders: DataFrame) -> DataFrame:
    k, c, kind = F.col("k"), F.col("c"), F.col("kind")
    received = F.col("approved") & (k % 20 >= 3)
    causes = {
        NORMAL: received,
        DUPLICATE: received & (k % 109 == 1),
        NEAR_DUPLICATE: received & (k % 163 == 2),
        MATCH: F.col("approved") & (k % 67 == 3),
        MAVERICK: k % 89 == 4,
        AFTER_HOURS: F.col("approved") & (k % 131 == 5),
        ROUND: k % 149 == 6,
        GHOST: k % 269 == 7,
    }
    kinds = F.array(*[F.when(cond, F.lit(code)) for code, cond in causes.items()])
    landed = plus_days(F.col("day"), k % 43 + 8)
    weekday = F.weekday(landed)
    working_day = plus_days(landed, F.when(weekday >= 5, 7 - weekday).otherwise(0))
    usual = plus_hours(working_day, k % 11 + 8)
    ghost_day = plus_days(F.lit("2001-06-15").cast("timestamp"), k % 18 + 3)

    sign = F.when(k % 2 == 0, F.lit(1)).otherwise(F.lit(-1))
    base_cents = _per_mille(c, k % 61 + 970)

    seen = (
        orders
        .withColumn("kind", F.explode(kinds))
        .filter(kind.isNotNull())
        .withColumn("usual", usual)
        .withColumn("ic", base_cents)
        .withColumn(
            "invoice_date",
            _by_kind(
                kind,
                {
                    DUPLICATE: plus_days(F.col("usual"), k % 25 + 1),
                    NEAR_DUPLICATE: plus_days(F.col("usual"), k % 19 + 2),
                    AFTER_HOURS: plus_hours(F.col("day"), k % 5 + 19),
                    GHOST: plus_hours(ghost_day, k % 11 + 8),
                },
                F.col("usual"),
            ),
        )
        .withColumn(
            "amount",
            _by_kind(
                kind,
                {
                    NEAR_DUPLICATE: _per_mille(F.col("ic"), sign * (k % 15 + 5) + 1000),
                    MATCH: _per_mille(c, sign * (k % 290 + 60) + 1000),
                    ROUND: (k % 50 + 1) * 1_000_000,
                    GHOST: (k * 7919) % 180_000_000 + 20_000_000,
                },
                F.col("ic"),
            ),
        )
        .withColumn("taxed", F.when(kind == NEAR_DUPLICATE, F.col("ic")).otherwise(F.col("amount")))
        .withColumn("tax", _per_mille(F.col("taxed"), F.lit(180)))
        .withColumn(
            "terms",
            F.when(kind == GHOST, 15)
            .when(k % 4 == 0, 30)
            .when(k % 4 == 1, 45)
            .when(k % 4 == 2, 60)
            .otherwise(90),
        )
        .withColumn(
            "invoice_status",
            F.when(kind == MATCH, "Blocked")
            .when((kind == NORMAL) & (k % 20 == 19), "Open")
            .otherwise("Paid"),
        )
    )
    with_po = ~kind.isin(MAVERICK, ROUND, GHOST)
    paid = F.col("invoice_status") == "Paid"
    pay_day = plus_hours(
        plus_days(F.date_trunc("day", "invoice_date"), F.col("terms") + k % 16 - 5), k % 24
    )
    reference = _by_kind(
        kind,
        {
            NEAR_DUPLICATE: _code("VN", k),
            MATCH: _code("VM", k),
            MAVERICK: _code("VK", k),
            AFTER_HOURS: _code("VA", k),
            ROUND: _code("VR", k),
            GHOST: _code("VG", k),
        },
        _code("V", k),
    )
    type_names = F.array(*[F.lit(t) for t in ANOMALY_TYPES])
    labels = {
        "is_duplicate": DUPLICATE,
        "is_near_duplicate": NEAR_DUPLICATE,
        "is_match_failure": MATCH,
        "is_maverick": MAVERICK,
        "is_after_hours": AFTER_HOURS,
        "is_round_number": ROUND,
        "is_ghost_vendor_inv": GHOST,
    }
    return _as(
        seen.select(
            F.concat(F.lit("INV"), kind.cast("string"), F.lit("-"), k.cast("string")).alias("invoice_number"),
            "invoice_date",
            reference.alias("vendor_invoice_number"),
            F.when(kind == GHOST, _code("GHOST", k % 15)).otherwise(F.col("vendor_id")).alias("vendor_id"),
            F.when(with_po, _code("PO", k)).alias("po_number"),
            F.when(with_po & received, _code("GR", k)).alias("gr_number"),
            _cents(F.col("amount")).alias("invoice_amount"),
            _cents(F.col("tax")).alias("tax_amount"),
            _cents(F.col("amount") + F.col("tax")).alias("total_amount"),
            F.col("terms").alias("payment_terms_days"),
            plus_days(F.col("invoice_date"), F.col("terms")).alias("due_date"),
            F.when(paid, pay_day).alias("payment_date"),
            F.when(paid, _cents(F.col("amount") + F.col("tax"))).alias("payment_amount"),
            "invoice_status",
            F.col("user_id").alias("processed_by"),
            F.when(F.col("invoice_status") != "Blocked", F.col("user_id")).alias("approved_by"),
            "cost_centre",
            *[(kind == code).alias(name) for name, code in labels.items()],
            F.when(kind == NORMAL, 0).otherwise(1).alias("anomaly_flag"),
            F.get(type_names, kind).alias("anomaly_type"),
        ),
        "invoices",
    )


def erp_tables(spark: SparkSession, sf_dir: str) -> ErpTables:
    """All six views. Times are UTC wall-clock, whatever the machine's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    orders = _orders(spark, sf_dir)
    return ErpTables(
        users=users(spark, sf_dir),
        vendors=vendors(spark, sf_dir),
        budget=budget(orders),
        purchase_orders=purchase_orders(orders),
        goods_receipts=goods_receipts(orders),
        invoices=invoices(orders),
    )


stored: dict[tuple[str, str], ErpTables] = {}


def stored_tables(spark: SparkSession, sf_dir: str) -> ErpTables:
    """The six tables written once per application to the shared folder, so
    that every later query prunes columns and pushes filters down to them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in stored:
        root = new_path(spark, "erp")
        views = erp_tables(spark, sf_dir).items()
        with ThreadPoolExecutor(len(views)) as pool:  # independent jobs, one per table
            list(pool.map(lambda item: item[1].write.parquet(f"{root}/{item[0]}"), views))
        stored[key] = open_tables(spark, root)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return stored[key]
