"""Whole pipelines: Bronze to Silver, and Silver to Gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.config import (
    AggSpec,
    ColumnSpec,
    FieldMap,
    GoldSpec,
    Metric,
    Relation,
    RuleSet,
    SilverSpec,
    TableSpec,
    When,
)
from tributary.functions import clock
from tributary.functions.money import minor
from tributary.operators import gaps, joins, mapping, nested, sets, validate
from tributary.operators.lineage import StageMeter
from tributary.plans.layers import to_gold, to_silver
from tributary.plans.registry import query, table
from tributary.session import scratch_path

SILVER = SilverSpec(
    keys=("id",),
    order_column="modified",
    normalize={"customer_email": {"type": "email"}, "customer_phone": {"type": "phone"}},
    convert={"modified": {"type": "bigint_to_timestamp"}},
    critical=("customer_email", "status"),
    defaults={"status": "UNKNOWN"},
)


def bronze_orders(spark, sf):
    """Each line as one arriving version of its order: nested, padded, all text."""
    # Texts of the order are made before the join, once an order instead of once a line.
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", F.date_format("o_orderdate", "dd/MM/yyyy").alias("created")
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    key = F.col("l_orderkey").cast("string")
    version = (F.col("l_linenumber") * 1000000 + F.col("l_partkey") * 100 + F.col("l_suppkey") % 100).cast("bigint")
    return lines.join(o, "l_orderkey").select(
        F.concat(F.lit(" "), key, F.lit(" ")).alias("id"),
        version.alias("modified"),
        F.concat(F.lit("  "), F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit(" ")).alias("status"),
        F.struct(
            F.concat(F.lit(" U"), F.col("o_custkey").cast("string"), F.lit("@Shop.PE ")).alias("email"),
            F.concat(F.lit("(01) "), F.col("o_custkey").cast("string")).alias("phone"),
        ).alias("customer"),
        F.col("l_quantity").cast("string").alias("amount"),
        "created",
        F.when(F.col("l_quantity") > 25, "yes").otherwise("no").alias("gift"),
    )


@query(
    "bronze_to_silver",
    """
    WITH v AS (
      SELECT l_orderkey, l_linenumber * 1000000 + l_partkey * 100 + l_suppkey % 100 AS m, o_custkey, o_orderstatus,
             l_quantity, o_orderdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT CAST(l_orderkey AS VARCHAR) AS id, m AS modified,
           coalesce(nullif(o_orderstatus, 'P'), 'UNKNOWN') AS status,
           'u' || o_custkey || '@shop.pe' AS customer_email, '+5101' || o_custkey AS customer_phone,
           CAST(l_quantity AS DOUBLE) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS created, l_quantity > 25 AS gift,
           o_orderstatus = 'P' AS has_critical_gaps
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY m DESC, l_quantity DESC) AS n FROM v) WHERE n = 1
    """,
)
def bronze_to_silver(spark, sf):
    silver = to_silver(bronze_orders(spark, sf), SILVER)
    return silver.withColumns(
        {
            "modified": clock.to_epoch(F.col("modified")),
            "amount": F.col("amount").cast("double"),
            "created": F.date_format("created", "yyyy-MM-dd"),
        }
    )


GOLD = GoldSpec(
    table="order_sums",
    field_map=(
        FieldMap("branch", "c_nationkey", "bigint_to_string"),
        FieldMap("state", "o_orderstatus"),
        FieldMap("amount", "amount"),
        FieldMap("day", "o_orderdate"),
    ),
    formulas={"fee": "amount * 2"},
    timestamp_column="o_orderdate",
    aggregate=AggSpec(("branch", "state"), (Metric("amount", ("sum", "min", "max")), Metric("fee", ("sum",)), Metric("*", ("count",)))),
    rules=RuleSet(
        critical=("branch", "state"),
        valid_values={"state": ("F", "O")},
        ranges={"num_registros": (50, None)},
        consistency=(When("state", "F", "total_amount"),),
    ),
)


@query(
    "silver_to_gold",
    """
    WITH a AS (
      SELECT CAST(c_nationkey AS VARCHAR) AS branch, o_orderstatus AS state, CAST(sum(x) AS BIGINT) AS total_amount,
             min(x) AS min_amount, max(x) AS max_amount, CAST(sum(x * 2) AS BIGINT) AS total_fee, count(*) AS num_registros
      FROM (SELECT *, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS x FROM orders) JOIN customer ON c_custkey = o_custkey
      WHERE o_orderdate > TIMESTAMP '1996-06-01' GROUP BY 1, 2)
    SELECT *, state IN ('F', 'O') AND num_registros >= 50 AS _quality_valid,
           concat(CASE WHEN state NOT IN ('F', 'O') THEN 'VALIDITY_FAIL;' END, CASE WHEN num_registros < 50 THEN 'RANGE_FAIL;' END)
             AS _quality_issues, NOT (state IN ('F', 'O') AND num_registros >= 50) AS _error_handled
    FROM a
    """,
)
def silver_to_gold(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    silver = table(spark, sf, "orders").withColumn("amount", minor(F.col("o_totalprice"))).join(c, "o_custkey")
    return to_gold(silver, GOLD, F.lit("2002-01-01").cast("timestamp_ntz"), "1996-06-01").rows


ORDER_TABLE = TableSpec(
    "orders",
    {
        "o_orderkey": ColumnSpec("BIGINT", nullable=False, primary_key=True, source_field="id"),
        "o_totalprice": ColumnSpec("DECIMAL(18,2)", calculated=True),
        "note": ColumnSpec("VARCHAR(20)", data_gap=True),
        "missing": ColumnSpec("INT", source_field="x"),
    },
)


_VALIDATE_SQL = """
    WITH n AS (SELECT count(*) AS a, count(nullif(o_orderstatus, 'P')) AS g FROM orders)
    SELECT 'schema' AS "check", 'missing' AS "column", 'FAIL' AS status, NULL::BIGINT AS detail FROM n
    UNION ALL SELECT 'schema', 'o_custkey', 'WARN', NULL FROM n
    UNION ALL SELECT 'not_empty', '*', 'PASS', a FROM n
    UNION ALL SELECT 'calculated', 'o_totalprice', 'PASS', a FROM n
    UNION ALL SELECT 'gap', 'note', 'WARN', a - g FROM n
    UNION ALL SELECT 'required', 'o_orderkey', 'PASS', 0 FROM n
"""


@query("validate_table", _VALIDATE_SQL)
def validate_table(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("note")
    )
    return validate.validate(o, ORDER_TABLE)


@query(
    "validation_status",
    f"""
    SELECT count(*) FILTER (WHERE status = 'FAIL') AS failures,
           CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM ({_VALIDATE_SQL})
    """,
)
def validation_status(spark, sf):
    return validate.overall(validate_table(spark, sf))


@query(
    "stage_metrics",
    """
    WITH c AS (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R') AS b,
                      (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_returnflag <> 'R') AS d)
    SELECT 'read' AS stage, a AS records_in, a AS records_out, 0::BIGINT AS records_dropped, 0.0::DOUBLE AS drop_rate FROM c
    UNION ALL SELECT 'filter', a, b, a - b, CAST(a - b AS DOUBLE) / CAST(a AS DOUBLE) FROM c
    UNION ALL SELECT 'group', b, d, b - d, CAST(b - d AS DOUBLE) / CAST(b AS DOUBLE) FROM c
    """,
)
def stage_metrics(spark, sf):
    """Rows of each stage, observed by the job that writes the result."""
    meter = StageMeter("sales")
    df = meter.watch(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), "read")
    df = meter.watch(df.filter("l_returnflag <> 'R'"), "filter")
    df = meter.watch(df.groupBy("l_orderkey").count(), "group")
    df.write.parquet(scratch_path(spark, "metrics"))
    report = meter.report(spark, F.lit("2026-01-01").cast("timestamp"))
    return report.select("stage", "records_in", "records_out", "records_dropped", "drop_rate")


def raw_orders(spark, sf):
    """Orders in the shape the sales channel sends them: lists, maps and deep structs."""
    key, buyer = F.col("o_orderkey"), F.col("o_custkey")
    address = lambda n: F.struct(
        (buyer + n).alias("id"), F.concat(F.lit("city"), F.lit(n).cast("string")).alias("city"), F.lit("N").alias("neighborhood"),
        F.lit("C").alias("complement"), F.array(buyer * -1.0, buyer * -0.5 - n).alias("geolocation"),
    )
    shipping = F.struct(
        (key * 2).alias("id"), F.col("o_orderpriority").alias("carrierId"),
        F.struct(key.alias("initialDate"), (key + 1).alias("finalDate")).alias("deliveryWindow"), (key + 2).alias("dateModified"),
    )
    item = lambda n: F.struct(
        (key * 10 + n).alias("id"), F.concat(F.lit("K"), F.lit(n).cast("string")).alias("skuId"), F.lit(n * 1.5).alias("purchasedQuantity")
    )
    return table(spark, sf, "orders").select(
        key.alias("id"),
        key.cast("string").alias("commerceSequentialId"),
        F.struct(buyer.alias("id")).alias("customer"),
        F.array(address(1), address(2)).alias("addresses"),
        F.create_map("o_orderstatus", F.lit("x")).alias("statusPerLocation"),
        F.struct(F.struct(F.col("o_totalprice").alias("amount")).alias("items")).alias("totals"),
        F.when(F.col("o_orderstatus") == "P", F.array(shipping, shipping)).otherwise(F.array(shipping)).alias("shippings"),
        F.array(item(1), item(2)).alias("items"),
        F.struct(F.struct(F.col("o_orderpriority").alias("dateEnd")).alias("picking")).alias("steps"),
    )


@query(
    "order_fields",
    """
    SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS seq_id, o_custkey AS customer, o_custkey + 1 AS customer_address,
           o_orderstatus AS store, o_totalprice AS total_items, o_orderpriority AS date_picked, CAST(NULL AS VARCHAR) AS invoice_date
    FROM orders
    """,
)
def order_fields(spark, sf):
    out = mapping.order_fields(raw_orders(spark, sf))
    return out.select("id", "seq_id", "customer", "customer_address", "store", "total_items", "date_picked", "invoice_date")


@query(
    "item_fields",
    """
    SELECT o_orderkey * 10 + n AS id, o_orderkey AS order_id, 'K' || n AS sku, CAST(n * 1.5 AS DOUBLE) AS quantity,
           CAST(NULL AS VARCHAR) AS name FROM orders, (VALUES (1), (2)) v(n)
    """,
)
def item_fields(spark, sf):
    return mapping.item_fields(raw_orders(spark, sf)).select("id", "order_id", "sku", "quantity", "name")


@query(
    "shipping_fields",
    """
    SELECT o_orderkey * 2 AS id, o_orderkey AS order_id, 'city' || n AS city, o_custkey * -0.5::DOUBLE - n AS lat,
           o_custkey * -1.0::DOUBLE AS lng, o_orderpriority AS carrier_id, o_orderkey AS shipping_window_start,
           o_orderkey + 1 AS shipping_window_end, o_orderkey + 2 AS shipped_date_end
    FROM orders, (VALUES (1), (2)) v(n) WHERE n = 1 OR o_orderstatus = 'P'
    """,
)
def shipping_fields(spark, sf):
    return mapping.shipping_fields(raw_orders(spark, sf)).select(
        "id", "order_id", "city", "lat", "lng", "carrier_id", "shipping_window_start", "shipping_window_end", "shipped_date_end"
    )


@query(
    "split_entity",
    """
    SELECT o_orderkey AS order_id, 'customer' AS part, CAST(o_custkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT o_orderkey, 'items', 'K' || n FROM orders, (VALUES (1), (2)) v(n)
    UNION ALL SELECT o_orderkey, 'locations', o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, 'parent', CAST(o_totalprice >= 100000 AS VARCHAR) FROM orders
    """,
)
def split_entity(spark, sf):
    """One entity to its parent and three kinds of child tables."""
    parts = nested.split_entity(
        raw_orders(spark, sf),
        (
            Relation("customer", "customer", "order_id", "one_to_one"),
            Relation("items", "items", "order_id"),
            Relation("statusPerLocation", "locations", "order_id", "key_value"),
        ),
    )
    values = {"customer": F.col("id"), "items": F.col("skuId"), "locations": F.col("field")}
    rows = {n: parts[n].select("order_id", v.cast("string").alias("value")) for n, v in values.items()}
    rows["parent"] = parts[""].select(
        F.col("id").alias("order_id"), (F.col("totals_items_amount") >= 100000).cast("string").alias("value")
    )
    return sets.union_tenants(rows, "part").select("order_id", "part", "value")


@query(
    "gap_columns",
    """
    SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS note, 'orders' AS run FROM orders
    """,
)
def gap_columns(spark, sf):
    """Known gaps as typed nulls, constants as literals, then the target columns that exist."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    wide = joins.with_constants(gaps.add_gap_columns(o, ORDER_TABLE), run="orders")
    chosen, missing = nested.project(wide, ["o_orderkey", "o_totalprice", "note", "run", "missing"])
    if missing != ["missing"]:
        raise ValueError(f"unexpected missing columns: {missing}")
    return chosen
