"""Nesting, duplicates, conflicts and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.config import ColumnSpec, TableSpec
from tributary.functions import clock
from tributary.functions.paths import first_map_key, json_path, path_column
from tributary.functions.text import valid_json
from tributary.operators import dedup, gaps, nested
from tributary.operators.windows import dense_group_id, top_per_key
from tributary.plans.registry import query, table
from tributary.sources.readers import unwrap_envelope, unwrap_pages, wrap_envelope


def nested_orders(spark, sf):
    """Orders as nested records: structs, an array of changes (0 to 3), pairs of arrays, a map."""
    changes = F.col("o_custkey") % 4
    steps = F.when(changes > 0, F.sequence(F.lit(1), changes.cast("int"))).otherwise(F.array().cast("array<int>"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("level")).alias("customer"),
        F.struct(
            F.struct(F.col("o_totalprice").alias("amount"), F.lit(1).alias("quantity")).alias("items"),
            F.struct((F.col("o_custkey") * 1.0).alias("amount")).alias("shipping"),
        ).alias("totals"),
        F.col("o_orderstatus").alias("customer_id"),
        F.transform(
            steps,
            lambda n: F.struct(
                n.alias("step"),
                F.concat(F.lit("S"), n.cast("string")).alias("status"),
                F.struct((F.col("o_orderkey") * 10 + n).alias("by")).alias("audit"),
            ),
        ).alias("changes"),
        F.transform(steps, lambda n: F.col("o_orderkey") + n).alias("lat"),
        F.transform(F.sequence(F.lit(1), F.lit(2)), lambda n: F.col("o_custkey") * n).alias("lng"),
        F.create_map(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("per_location"),
        F.struct(
            F.col("o_orderpriority").alias("note"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("gift"),
        ).alias("custom"),
    )


@query(
    "flatten_struct",
    """
    SELECT o_orderkey AS id, o_custkey AS customer_id_1, o_orderpriority AS customer_level,
           o_totalprice AS totals_items_amount, 1 AS totals_items_quantity, o_custkey * 1.0::DOUBLE AS totals_shipping_amount,
           o_orderstatus AS customer_id
    FROM orders
    """,
)
def flatten_struct(spark, sf):
    return nested.flatten(nested_orders(spark, sf).select("id", "customer", "totals", "customer_id"))


@query(
    "flatten_explode",
    """
    SELECT o_orderkey AS id, n::INTEGER AS changes_step, 'S' || n AS changes_status, o_orderkey * 10 + n AS changes_audit_by
    FROM orders, unnest(range(1, (o_custkey % 4) + 1)) AS u(n)
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL FROM orders WHERE o_custkey % 4 = 0
    """,
)
def flatten_explode(spark, sf):
    return nested.flatten(nested_orders(spark, sf).select("id", "changes"), arrays="explode")


@query(
    "child_table",
    """
    SELECT o_orderkey AS order_id, (n - 1)::INTEGER AS position, n::INTEGER AS step, 'S' || n AS status,
           o_orderkey * 10 + n AS audit_by
    FROM orders, unnest(range(1, (o_custkey % 4) + 1)) AS u(n)
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL FROM orders WHERE o_custkey % 4 = 0
    """,
)
def child_table(spark, sf):
    return nested.child_table(nested_orders(spark, sf), "changes", "id", "order_id", ordinal=True)


@query(
    "one_to_one_table",
    "SELECT o_orderkey AS order_id, o_custkey AS id, o_orderpriority AS level FROM orders",
)
def one_to_one_table(spark, sf):
    return nested.one_to_one_table(nested_orders(spark, sf), "customer", "id", "order_id")


@query(
    "key_value_table",
    """
    SELECT o_orderkey AS order_id, 'note' AS field, o_orderpriority AS value FROM orders
    UNION ALL SELECT o_orderkey, 'gift', CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END FROM orders
    """,
)
def key_value_table(spark, sf):
    return nested.key_value_table(nested_orders(spark, sf), "custom", "id", "order_id")


@query(
    "key_value_map",
    "SELECT o_orderkey AS order_id, o_orderstatus AS field, o_orderpriority AS value FROM orders",
)
def key_value_map(spark, sf):
    return nested.key_value_table(nested_orders(spark, sf), "per_location", "id", "order_id")


@query(
    "zip_arrays",
    """
    SELECT o_orderkey AS id, (n - 1)::INTEGER AS position,
           CASE WHEN n <= o_custkey % 4 THEN o_orderkey + n END AS lat,
           CASE WHEN n <= 2 THEN o_custkey * n END AS lng
    FROM orders, unnest(range(1, greatest(o_custkey % 4, 2) + 1)) AS u(n)
    """,
)
def zip_arrays(spark, sf):
    return nested.zip_arrays(nested_orders(spark, sf), "id", ["lat", "lng"])


@query(
    "array_counts",
    """
    SELECT o_orderkey AS id, CAST(o_custkey % 4 AS INTEGER) AS changes,
           CAST(CASE WHEN o_custkey % 4 >= 2 THEN 1 ELSE 0 END AS INTEGER) AS seconds,
           CAST(nullif(o_custkey % 4, 0) AS INTEGER) AS last_step,
           CASE WHEN o_custkey % 4 > 0 THEN 'S1' END AS first_status,
           CASE WHEN o_custkey % 4 > 0 THEN o_orderkey * 10 + 1 END AS first_by,
           o_orderstatus AS location, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS absent
    FROM orders
    """,
)
def array_counts(spark, sf):
    df = nested_orders(spark, sf)
    return df.select(
        "id",
        nested.array_length(F.col("changes")).alias("changes"),
        nested.count_where(F.col("changes"), lambda e: e["status"] == "S2").alias("seconds"),
        nested.array_field_max(F.col("changes"), "step").alias("last_step"),
        path_column(df, "changes[0].status").alias("first_status"),
        path_column(df, "changes[].audit.by").alias("first_by"),
        first_map_key(F.col("per_location")).alias("location"),
        path_column(df, "totals.items.amount").alias("amount"),
        path_column(df, "totals.nothing.amount").alias("absent"),
    )


@query(
    "json_path",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k,
           CASE WHEN event_type <> 'error' THEN props END AS checked,
           json_extract_string('{"a":[{"c":' || user_id || '}]}', '$.a[0].c') AS first_c
    FROM events
    """,
)
def json_values(spark, sf):
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    made = F.concat(F.lit('{"a":[{"c":'), F.col("user_id").cast("string"), F.lit("}]}"))
    return table(spark, sf, "events").select(
        "event_id",
        json_path(F.col("props"), "k").alias("k"),
        valid_json(broken).alias("checked"),
        json_path(made, "a[].c").alias("first_c"),
    )


@query(
    "complex_to_json",
    """
    SELECT o_orderkey AS id, '{"id":' || o_custkey || ',"level":"' || o_orderpriority || '"}' AS customer,
           '[' || o_custkey || ',' || o_custkey * 2 || ']' AS lng
    FROM orders
    """,
)
def complex_to_json(spark, sf):
    return nested.complex_to_json(nested_orders(spark, sf).select("id", "customer", "lng"))


@query(
    "envelope",
    """
    SELECT 'shop' AS _metadata_client_id, 'orders' AS _metadata_entity_type,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS _metadata_ingestion_timestamp, 'polling' AS _metadata_source,
           'v2' AS _metadata_api_version, o_orderkey, o_orderstatus, o_orderdate::DATE AS o_orderdate
    FROM orders
    """,
)
def envelope(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    wrapped = wrap_envelope(o, "shop", "orders", "polling", F.col("o_orderdate"))
    out = unwrap_envelope(wrapped)
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query(
    "unwrap_pages",
    """
    SELECT event_type, event_id AS id, user_id AS "user" FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_type, event_id + 1000000, user_id FROM events WHERE event_type IN ('view', 'signup')
    """,
)
def pages(spark, sf):
    kind = F.col("event_type")
    one = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("user")))
    two = F.to_json(F.struct((F.col("event_id") + 1000000).alias("id"), F.col("user_id").alias("user")))
    payload = (
        F.when(kind.isin("view", "signup"), F.concat(F.lit("["), one, F.lit(","), two, F.lit("]")))
        .when(kind == "error", F.lit('"none"'))
        .otherwise(F.concat(F.lit('{"data":['), one, F.lit('],"pagination":{"page":1,"hasNextPage":false}}')))
    )
    rows = table(spark, sf, "events").select("event_type", payload.alias("payload"))
    return unwrap_pages(rows, "payload", "struct<id:bigint,user:bigint>")


LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
]


@query(
    "mark_duplicates",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_duplicate
    FROM lineitem
    """,
)
def mark_duplicates(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedup.mark_duplicates(lines, ["l_orderkey", "l_linenumber"], stored=True).drop("duplicate_group_id")


@query(
    "mark_duplicates_hot",
    """
    SELECT l_returnflag, n AS linestatus, l_orderkey, count(*) OVER (PARTITION BY l_returnflag, n) > 1 AS is_duplicate
    FROM (SELECT *, nullif(l_linestatus, 'O') AS n FROM lineitem)
    """,
)
def mark_duplicates_hot(spark, sf):
    """Six keys (one with nulls) hold all rows; every one of them is salted."""
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", F.nullif(F.col("l_linestatus"), F.lit("O")).alias("linestatus"), "l_orderkey"
    )
    return dedup.mark_duplicates(lines, ["l_returnflag", "linestatus"], min_hot_rows=1000).drop("duplicate_group_id")


@query(
    "dense_group_id",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, rank() OVER (ORDER BY l_orderkey, l_linenumber) AS duplicate_group_id
    FROM lineitem
    """,
)
def group_ids(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dense_group_id(lines, ["l_orderkey", "l_linenumber"])


@query(
    "resolve_conflicts",
    """
    WITH raw AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year(l_shipdate) AS shipped,
                        nullif(l_returnflag, 'A') AS flag, nullif(l_linestatus, 'O') AS status,
                        l_quantity, l_extendedprice FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, shipped::INTEGER AS shipped, flag, status, l_quantity,
           l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY shipped DESC,
            (flag IS NULL)::INT + (status IS NULL)::INT, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM raw)
    WHERE n = 1
    """,
)
def resolve_conflicts(spark, sf):
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.year("l_shipdate").alias("shipped"),
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("flag"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("status"),
        "l_quantity", "l_extendedprice",
    )
    ties = [F.col(c).asc() for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    return dedup.resolve_conflicts(raw, ["l_orderkey", "l_linenumber"], "shipped", tie_break=ties)


@query(
    "pk_violations",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1
    """,
)
def pk_violations(spark, sf):
    return dedup.pk_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "pk_summary",
    """
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    """,
)
def pk_summary(spark, sf):
    return dedup.pk_summary(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "source_priority_dedup",
    """
    SELECT user_id, event_type, event_id, source
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY seen DESC, CASE source WHEN 'webhook' THEN 1 WHEN 'polling' THEN 2 ELSE 3 END, event_id) AS n
          FROM (SELECT *, year(ts) * 10000 + month(ts) * 100 + day(ts) AS seen,
                  CASE event_id % 3 WHEN 0 THEN 'webhook' WHEN 1 THEN 'polling' ELSE 'initial_load' END AS source
                FROM events))
    WHERE n = 1
    """,
)
def source_priority(spark, sf):
    turn = F.col("event_id") % 3
    copies = table(spark, sf, "events").select(
        "user_id", "event_type", "event_id", clock.day_key(F.col("ts")).alias("seen"),
        F.when(turn == 0, "webhook").when(turn == 1, "polling").otherwise("initial_load").alias("source"),
    )
    best = dedup.resolve_conflicts(
        copies, ["user_id", "event_type"], "seen", dedup.source_rank(F.col("source")),
        tie_break=[F.col("event_id").asc()],
    )
    return best.drop("seen")


@query(
    "least_nulls_dedup",
    """
    SELECT user_id, event_type, event_id, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY (v IS NULL)::INT, ts DESC) AS n, v AS value
          FROM (SELECT user_id, event_type, event_id, ts, CASE WHEN value < 25 THEN value END AS v FROM events))
    WHERE n = 1
    """,
)
def least_nulls(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_type", "event_id", "ts", F.when(F.col("value") < 25, F.col("value")).alias("value")
    )
    best = dedup.resolve_conflicts(rows, ["user_id", "event_type"], "ts", strategy="least_nulls")
    return best.drop("ts")


@query(
    "merge_versions",
    """
    SELECT user_id, event_type, max(event_id) AS event_id,
           arg_max(value, event_id) FILTER (WHERE value < 25) AS value,
           arg_max(props, event_id) FILTER (WHERE value >= 10) AS props
    FROM events GROUP BY user_id, event_type
    """,
)
def merge_versions(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_type", "event_id",
        F.when(F.col("value") < 25, F.col("value")).alias("value"),
        F.when(F.col("value") >= 10, F.col("props")).alias("props"),
    )
    return dedup.merge_versions(rows, ["user_id", "event_type"], "event_id")


def gappy_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
    )


_GAPPY = """
    raw AS (SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_name END AS name,
                   CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance,
                   nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
"""


@query(
    "critical_gaps",
    f"""
    WITH {_GAPPY}
    SELECT c_custkey, coalesce(name, 'unknown') AS name, coalesce(balance, 0.0) AS balance, segment,
           name IS NULL OR balance IS NULL AS has_critical_gaps
    FROM raw
    """,
)
def critical_gaps(spark, sf):
    return gaps.handle_gaps(gappy_customers(spark, sf), ["name", "balance"], {"name": "unknown", "balance": 0.0})


@query(
    "reject_incomplete",
    f"""
    WITH {_GAPPY}
    SELECT c_custkey, coalesce(name, 'unknown') AS name, balance, segment, FALSE AS has_critical_gaps
    FROM raw WHERE balance IS NOT NULL AND segment IS NOT NULL
    """,
)
def reject_incomplete(spark, sf):
    return gaps.handle_gaps(
        gappy_customers(spark, sf), ["name", "balance", "segment", "absent"], {"name": "unknown"}, reject=True,
        fill_first=True,
    )


@query(
    "gap_report",
    f"""
    WITH {_GAPPY}
    SELECT 'total' AS kind, 'records' AS name, count(*) AS records FROM raw
    UNION ALL SELECT 'total', 'records_with_gaps', count(*) FROM raw
    UNION ALL SELECT 'unavailable', f, count(*) FROM raw, (VALUES ('name'), ('balance'), ('segment')) v(f) GROUP BY f
    UNION ALL SELECT 'calculated', 'name', count(name) FROM raw
    UNION ALL SELECT 'calculated', 'balance', count(balance) FROM raw
    UNION ALL SELECT 'calculated', 'segment', count(segment) FROM raw
    UNION ALL SELECT 'impact', 'medium', count(*) FROM raw
    """,
)
def gap_report(spark, sf):
    rows = gappy_customers(spark, sf)
    impact = {"name": "low", "balance": "medium"}
    marked = rows.withColumn("_data_gaps", gaps.gap_metadata(rows, ["name", "balance", "segment"], impact))
    return gaps.gap_report(marked)


@query(
    "gap_impact",
    "SELECT CASE WHEN count(*) > 0 THEN 'medium' ELSE 'none' END AS impact_assessment FROM customer",
)
def gap_impact(spark, sf):
    return gaps.overall_impact(gap_report(spark, sf))


@query(
    "missing_quantity",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS quantity,
           l_quantity - coalesce(CASE WHEN l_returnflag <> 'R' THEN floor(l_quantity * 0.5) END, 0) AS missing
    FROM lineitem
    """,
)
def missing_quantity(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_returnflag") != "R", F.floor(F.col("l_quantity") * 0.5)).alias("quantity_picked"),
    )
    return rows.withColumn("missing", gaps.missing_quantity(rows)).drop("quantity_picked")


_THIN = "SELECT event_id, event_type, ts, CASE WHEN value < 15 THEN value END AS v FROM events"


@query(
    "forward_fill",
    f"""
    SELECT event_id, event_type, f AS value, v IS NULL AND f IS NOT NULL AS _value_imputed
    FROM (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM ({_THIN}))
    """,
)
def forward_fill(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", "ts", F.when(F.col("value") < 15, F.col("value")).alias("value")
    )
    return gaps.forward_fill(rows, ["event_type"], "ts", "value", ["event_id"]).drop("ts")


@query(
    "interpolate",
    f"""
    WITH n AS (
      SELECT *, epoch_us(ts) AS s,
        last_value(v IGNORE NULLS) OVER b AS bv,
        last_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER b AS bs,
        first_value(v IGNORE NULLS) OVER a AS av,
        first_value(CASE WHEN v IS NOT NULL THEN epoch_us(ts) END IGNORE NULLS) OVER a AS "as"
      FROM ({_THIN})
      WINDOW b AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             a AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
    SELECT event_id, event_type, f AS value, v IS NULL AND f IS NOT NULL AS _value_imputed
    FROM (SELECT *, coalesce(v, bv + (av - bv) *
            coalesce(CAST(s - bs AS DOUBLE) / nullif(CAST("as" - bs AS DOUBLE), 0), 0.0)) AS f FROM n)
    """,
)
def interpolate(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", "ts", F.when(F.col("value") < 15, F.col("value")).alias("value")
    )
    return gaps.interpolate(rows, ["event_type"], "ts", "value", ["event_id"]).drop("ts")


@query(
    "gap_log",
    """
    SELECT 'orders_note_0' AS gap_id, 'orders' AS entity_type, 'gold_orders' AS table_name, 'note' AS field_name,
           count(*) AS record_count FROM orders
    UNION ALL SELECT 'orders_weight_1', 'orders', 'gold_orders', 'weight', count(*) FROM orders
    """,
)
def gap_log(spark, sf):
    spec = TableSpec(
        "gold_orders",
        {
            "o_orderkey": ColumnSpec("BIGINT", source_field="id"),
            "note": ColumnSpec("VARCHAR(20)", data_gap=True, source_field="x"),
            "weight": ColumnSpec("DECIMAL(12,9)"),
            "fee": ColumnSpec("INT", calculated=True),
        },
    )
    o = table(spark, sf, "orders")
    return gaps.gap_log(o, spec, "orders", F.lit("2002-01-01").cast("timestamp")).drop("timestamp")


@query(
    "gap_trend",
    """
    SELECT event_type AS entity_type, 'value' AS field_name, CAST(sum(user_id) AS BIGINT) AS affected_records,
           count(*) AS occurrences
    FROM events WHERE ts >= TIMESTAMP '2024-01-23' GROUP BY event_type
    """,
)
def gap_trend(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("entity_type"), F.lit("value").alias("field_name"),
        F.col("user_id").alias("record_count"), F.col("ts").alias("timestamp"),
    )
    return gaps.gap_trends(log, F.lit("2024-01-23").cast("timestamp_ntz"))


@query(
    "gap_trend_daily",
    """
    SELECT ts::DATE AS day, CAST(sum(user_id) AS BIGINT) AS affected_records, count(*) AS occurrences
    FROM events WHERE ts >= TIMESTAMP '2024-01-23' GROUP BY 1
    """,
)
def gap_trend_daily(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("entity_type"), F.lit("value").alias("field_name"),
        F.col("user_id").alias("record_count"), F.col("ts").alias("timestamp"),
    )
    return gaps.gap_trends(log, F.lit("2024-01-23").cast("timestamp_ntz"), by_day=True)


@query(
    "top_per_key",
    """
    SELECT o_custkey, o_orderkey, o_totalprice
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
    WHERE n <= 3
    """,
)
def top_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_per_key(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 3)
