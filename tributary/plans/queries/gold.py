"""Mapping, calculation, aggregation, joins, quality and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.config import AggSpec, FieldMap, Metric, RuleSet, When
from tributary.functions import clock
from tributary.functions.money import minor
from tributary.functions.text import material_key
from tributary.operators import aggregate, errors, incremental, joins, lineage, mapping, quality, sets, validate
from tributary.operators.windows import surrogate_key
from tributary.plans.queries.silver import nested_orders
from tributary.plans.registry import query, table


@query(
    "map_schema",
    """
    SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_code, o_totalprice AS total_items,
           o_orderpriority AS customer_level, CASE WHEN o_custkey % 4 > 0 THEN 'S1' END AS first_status,
           o_orderstatus AS store, CAST(NULL AS VARCHAR) AS not_there,
           strftime(TIMESTAMP '1970-01-01' + to_seconds(o_orderkey), '%Y-%m-%d %H:%M:%S') AS created, 'run' AS _lineage
    FROM orders
    """,
)
def map_schema(spark, sf):
    df = nested_orders(spark, sf).withColumn("_lineage", F.lit("run"))
    fields = [
        FieldMap("order_id", "id"),
        FieldMap("customer_code", "customer.id", "bigint_to_string"),
        FieldMap("total_items", "totals.items.amount", "flatten"),
        FieldMap("customer_level", "customer.level", "flatten"),
        FieldMap("first_status", "changes[0].status", "array_first"),
        FieldMap("store", "per_location", "first_map_key"),
        FieldMap("not_there", "nothing.here"),
        FieldMap("created", "id", "timestamp_to_iso8601"),
        FieldMap("later", "calculated", "calculate"),
        FieldMap("children", "changes", "explode_array"),
    ]
    mapped = mapping.map_schema(df, fields)
    return mapped.withColumn("created", F.date_format("created", "yyyy-MM-dd HH:mm:ss"))


@query(
    "map_children",
    """
    SELECT o_orderkey AS order_id, n::INTEGER AS step, 'S' || n AS status, o_orderkey * 10 + n AS audit_by
    FROM orders, unnest(range(1, (o_custkey % 4) + 1)) AS u(n)
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL FROM orders WHERE o_custkey % 4 = 0
    """,
)
def map_children(spark, sf):
    fields = [FieldMap("order_changes", "changes", "explode_array"), FieldMap("order_custom", "custom", "key_value")]
    return mapping.map_children(nested_orders(spark, sf), fields, "id", "order_id")["order_changes"]


@query(
    "calc_fields",
    """
    SELECT o_orderkey, o_totalprice - o_custkey AS total_changes,
           CAST(epoch_us(o_orderdate + to_hours(o_custkey % 9)) // 1000000 - epoch_us(o_orderdate) // 1000000 AS BIGINT)
             AS total_time,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority WHEN o_orderstatus = 'P' THEN NULL
                ELSE o_orderstatus || ' ' || o_orderpriority END AS username,
           CAST(o_custkey % 5 - o_custkey % 3 AS BIGINT) AS quantity_difference,
           CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS days_since_created,
           CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END
             AS size_class,
           o_totalprice * 0.05 AS commission, o_custkey * 2 + 1 AS formula, CAST(NULL AS VARCHAR) AS unknown
    FROM orders
    """,
)
def calc_fields(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("total_items"),
        F.col("o_custkey").alias("total_original"),
        F.col("o_orderdate").alias("pick_start_time"),
        F.timestamp_add("HOUR", F.col("o_custkey") % 9, F.col("o_orderdate")).alias("pick_end_time"),
        F.when(~F.col("o_orderstatus").isin("F", "P"), F.col("o_orderstatus")).alias("firstname"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("lastname"),
        (F.col("o_custkey") % 3).alias("quantity"),
        (F.col("o_custkey") % 5).alias("quantity_picked"),
    )
    out = mapping.calculate(
        o,
        {
            "total_changes": None,
            "total_time": None,
            "username": None,
            "quantity_difference": None,
            "days_since_created": mapping.days_since(F.col("pick_start_time"), F.lit("2002-01-01").cast("date")),
            "size_class": mapping.size_class(F.col("total_items"), 100000, 300000),
            "commission": mapping.commission(F.col("total_items"), 0.05),
            "formula": "total_original * 2 + 1",
            "unknown": None,
        },
    )
    return out.drop(*[c for c in o.columns if c != "o_orderkey"])


def _branches(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("branch"))
    o = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderstatus").alias("state"), minor(F.col("o_totalprice")).alias("amount"), "o_orderdate"
    )
    return o.join(c, "o_custkey")


@query(
    "branch_state_agg",
    """
    SELECT c_nationkey AS branch, o_orderstatus AS state, CAST(sum(a) AS DOUBLE) / 100.0 AS total_amount,
           avg(a) / 100.0 AS promedio_amount, min(a) / 100.0 AS min_amount, max(a) / 100.0 AS max_amount,
           count(*) AS num_registros
    FROM (SELECT *, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS a FROM orders)
    JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
    """,
)
def branch_state_agg(spark, sf):
    spec = AggSpec(
        ("branch", "state", "not_there"),
        (Metric("amount", ("sum", "avg", "min", "max")), Metric("*", ("count",)), Metric("absent", ("sum",))),
    )
    out = aggregate.aggregate(_branches(spark, sf), spec)
    cents = ("total_amount", "promedio_amount", "min_amount", "max_amount")
    return out.withColumns({c: F.col(c).cast("double") / 100.0 for c in cents})


@query(
    "time_dims_agg",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(week(o_orderdate) AS INTEGER) AS week, count(*) AS num_registros
    FROM orders GROUP BY 1, 2, 3
    """,
)
def time_dims_agg(spark, sf):
    spec = AggSpec(("year", "month", "week"), (Metric("*", ("count",)),), "o_orderdate")
    return aggregate.aggregate(table(spark, sf, "orders").select("o_orderdate"), spec)


@query(
    "conditional_sums",
    """
    SELECT l_returnflag, CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS open_units,
           CAST(sum(CASE WHEN l_linestatus = 'F' AND l_discount > 0.05 THEN l_quantity ELSE 0 END) AS DOUBLE) AS deal_units,
           count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
           least(sum(l_quantity), 200000.0) AS capped_units
    FROM lineitem GROUP BY 1
    """,
)
def conditional_sums(spark, sf):
    lines = table(spark, sf, "lineitem")
    open_line, deal = F.col("l_linestatus") == "O", (F.col("l_linestatus") == "F") & (F.col("l_discount") > 0.05)
    return lines.groupBy("l_returnflag").agg(
        F.sum(F.when(open_line, F.col("l_quantity")).otherwise(0.0)).alias("open_units"),
        F.sum(F.when(deal, F.col("l_quantity")).otherwise(0.0)).alias("deal_units"),
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_partkey").alias("parts"),
        aggregate.capped(F.sum("l_quantity"), F.lit(200000.0)).alias("capped_units"),
    )


@query(
    "null_profile",
    """
    WITH r AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
                      CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer),
    p AS (SELECT 'c_custkey' AS "column", count(*) AS rows, count(c_custkey) AS filled FROM r
          UNION ALL SELECT 'segment', count(*), count(segment) FROM r
          UNION ALL SELECT 'balance', count(*), count(balance) FROM r)
    SELECT *, rows - filled AS nulls, CAST(rows - filled AS DOUBLE) / CAST(rows AS DOUBLE) AS null_share FROM p
    """,
)
def null_profile(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
    )
    return aggregate.profile(rows)


@query(
    "completeness",
    """
    SELECT CAST(count(c_custkey) + count(nullif(c_mktsegment, 'BUILDING')) AS DOUBLE) / CAST(2 * count(*) AS DOUBLE)
      AS completeness FROM customer
    """,
)
def completeness(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    return aggregate.completeness(rows)


@query(
    "describe_columns",
    """
    SELECT 'o_totalprice' AS "column", count(o_totalprice) AS "count", floor(avg(o_totalprice) * 100 + 0.5) / 100 AS mean,
           floor(stddev(o_totalprice) * 100 + 0.5) / 100 AS stddev, min(o_totalprice) AS min, max(o_totalprice) AS max
    FROM orders
    UNION ALL
    SELECT 'o_custkey', count(o_custkey), floor(avg(o_custkey) * 100 + 0.5) / 100,
           floor(stddev(o_custkey) * 100 + 0.5) / 100, min(o_custkey)::DOUBLE, max(o_custkey)::DOUBLE
    FROM orders
    """,
)
def describe_columns(spark, sf):
    out = aggregate.describe(table(spark, sf, "orders").select("o_totalprice", "o_custkey"))
    return out.withColumns({c: F.floor(F.col(c) * 100 + 0.5).cast("double") / 100 for c in ("mean", "stddev")})


@query(
    "freshness",
    """
    SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest, count(*) AS rows, count(DISTINCT user_id) AS distinct_keys,
           CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS high,
           CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed
    FROM events
    """,
)
def freshness(spark, sf):
    out = aggregate.freshness(
        table(spark, sf, "events"), "ts", "user_id",
        {"high": F.col("value") > 20, "failed": F.col("event_type") == "error"},
    )
    return out.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


@query(
    "scalar_bounds",
    "SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders WHERE o_orderstatus = 'P'",
)
def scalar_bounds(spark, sf):
    return aggregate.bounds(table(spark, sf, "orders").filter("o_orderstatus = 'P'"), "o_orderkey")


@query(
    "star_join",
    """
    SELECT s_suppkey, n_name AS nation, r_name AS region_name FROM supplier
    LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
    """,
)
def star_join(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    nation = joins.Dimension(
        table(spark, sf, "nation").withColumnRenamed("n_name", "nation"), ("n_nationkey",), ("nation", "n_regionkey")
    )
    region = joins.Dimension(
        table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("name")),
        ("n_regionkey",), ("name",), prefix="region_",
    )
    return joins.join_dims(s, [nation, region]).select("s_suppkey", "nation", "region_name")


@query(
    "enrich_lookup",
    """
    SELECT c_custkey, CASE WHEN s IS NOT NULL THEN s ELSE c_mktsegment END AS label
    FROM customer LEFT JOIN (SELECT s_nationkey, arg_max(s_name, (s_acctbal, s_suppkey)) AS s FROM supplier
                             WHERE s_acctbal > 2000 GROUP BY 1) ON s_nationkey = c_nationkey
    """,
)
def enrich_lookup(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label")
    )
    s = table(spark, sf, "supplier").filter("s_acctbal > 2000").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("label"), "s_acctbal", "s_suppkey"
    )
    out = joins.enrich(c, s, ["nation"], ["label"], [F.col("s_acctbal").desc(), F.col("s_suppkey").desc()])
    return out.drop("nation")


@query(
    "range_join",
    """
    WITH slots AS (SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS lo, min(ts) AS first_ts, count(*) AS n
                   FROM events GROUP BY 1, 2)
    SELECT e.event_id, epoch_us(s.lo) // 1000000 AS slot, s.n
    FROM events e LEFT JOIN slots s
      ON e.event_type = s.event_type AND e.ts >= s.first_ts + INTERVAL 30 MINUTE AND e.ts < s.lo + INTERVAL 8 HOUR
    """,
)
def range_join(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    slot = F.floor(clock.to_epoch(F.col("ts")) / 21600) * 21600
    slots = e.groupBy("event_type", slot.alias("slot")).agg(F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("n"))
    slots = slots.select(
        "event_type", "slot", "n",
        F.timestamp_add("MINUTE", F.lit(30), F.col("first_ts")).alias("lo"),
        clock.epoch_to_utc(F.col("slot") + 8 * 3600).alias("hi"),
    )
    out = joins.range_join(e, slots, ["event_type"], "ts", "lo", "hi", 6 * 3600, how="left")
    return out.select("event_id", "slot", "n")


@query(
    "range_join_open",
    """
    WITH r AS (SELECT user_id, date_trunc('second', min(ts) FILTER (WHERE event_type = 'purchase')) AS lo,
                      date_trunc('second', max(ts) FILTER (WHERE event_type = 'error')) AS hi FROM events GROUP BY user_id)
    SELECT e.event_id, r.lo IS NULL AS from_start, r.hi IS NULL AS to_end
    FROM events e JOIN r ON e.user_id = r.user_id AND (r.lo IS NULL OR e.ts >= r.lo) AND (r.hi IS NULL OR e.ts < r.hi)
      AND (r.lo IS NULL OR r.hi IS NULL OR r.hi > r.lo)
    """,
)
def range_join_open(spark, sf):
    """Events from each user's first purchase to the last error; without one or the other that end is open."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    when = lambda kind: F.when(F.col("event_type") == kind, F.date_trunc("second", "ts").cast("timestamp_ntz"))
    spans = e.groupBy("user_id").agg(F.min(when("purchase")).alias("lo"), F.max(when("error")).alias("hi"))
    out = joins.range_join_open(e.drop("event_type"), spans, ["user_id"], "ts", "lo", "hi", 3600)
    return out.select("event_id", F.col("lo").isNull().alias("from_start"), F.col("hi").isNull().alias("to_end"))


@query(
    "adjacent_slots",
    """
    WITH s AS (SELECT event_type, epoch_us(ts) // 1000000 // 3600 AS starts, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT a.event_type, a.starts, a.n, b.n AS following FROM s a
    LEFT JOIN s b ON a.event_type = b.event_type AND b.starts = a.starts + 1
    """,
)
def adjacent_slots(spark, sf):
    hour = F.floor(clock.to_epoch(F.col("ts")) / 3600)
    s = table(spark, sf, "events").groupBy("event_type", hour.alias("starts")).agg(F.count(F.lit(1)).alias("n"))
    s = s.withColumn("ends", F.col("starts") + 1)
    return joins.adjacent(s, ["event_type"], "starts", "ends", {"n": "following"}).drop("ends")


@query(
    "latest_inner",
    """
    SELECT user_id, event_id, event_type FROM events
    JOIN (SELECT user_id AS u, max(event_id) AS m FROM events GROUP BY 1) ON u = user_id AND m = event_id
    """,
)
def latest_inner(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return joins.latest_per_key(e, "user_id", "event_id")


@query(
    "latest_left",
    """
    SELECT user_id, event_id, event_type, m AS latest_id FROM events
    LEFT JOIN (SELECT user_id AS u, max(event_id) AS m FROM events GROUP BY 1) ON u = user_id AND m = event_id
    """,
)
def latest_left(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return joins.with_latest_flag(e, "user_id", "event_id")


@query(
    "computed_key_join",
    """
    SELECT p_partkey, s_suppkey FROM part JOIN supplier
      ON right('000000000000000000' || p_partkey, 18) = right('000000000000000000' || trim(' ' || s_suppkey || ' '), 18)
    """,
)
def computed_key_join(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", material_key(F.col("p_partkey")).alias("key"))
    padded = F.trim(F.concat(F.lit(" "), F.col("s_suppkey").cast("string"), F.lit(" ")))
    s = table(spark, sf, "supplier").select("s_suppkey", material_key(padded).alias("key"))
    return p.join(s, "key").drop("key")


@query(
    "fk_orphans",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size >= 10)
    """,
)
def fk_orphans(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.orphans(lines, table(spark, sf, "part").filter("p_size >= 10"), "l_partkey", "p_partkey")


@query(
    "semi_in",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#2')",
)
def semi_in(spark, sf):
    parts = table(spark, sf, "part").filter("p_brand = 'Brand#2'").select(F.col("p_partkey").alias("l_partkey"))
    return joins.semi(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), parts, ["l_partkey"])


@query(
    "anti_not_in",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def anti_not_in(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti(table(spark, sf, "orders").select("o_orderkey"), returned, ["o_orderkey"])


@query(
    "surrogate_key",
    """
    SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS sk FROM customer
    """,
)
def surrogate(spark, sf):
    return surrogate_key(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment", "c_custkey"])


@query(
    "tenant_union",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, 'buyers' AS origin FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, 'sellers' FROM supplier
    """,
)
def tenant_union(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return sets.union_tenants({"buyers": c, "sellers": s})


@query(
    "tenant_filter",
    "SELECT c_custkey, c_mktsegment AS client FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
)
def tenant_filter(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("client"))
    return sets.tenants(c, ["BUILDING", "MACHINERY"])


@query(
    "distinct_union_priority",
    """
    SELECT nation, name FROM (
      SELECT *, row_number() OVER (PARTITION BY nation ORDER BY p, name) AS n FROM (
        SELECT DISTINCT s_nationkey AS nation, s_name AS name, 0 AS p FROM supplier
        UNION ALL SELECT DISTINCT c_nationkey, c_name, 1 FROM customer))
    WHERE n = 1
    """,
)
def distinct_union_priority(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))
    return sets.union_by_priority([s, c], ["nation"], [F.col("name").asc()])


@query(
    "name_set_diff",
    """
    WITH a AS (SELECT DISTINCT p_brand AS name FROM part), b AS (SELECT DISTINCT 'Brand#' || s_suppkey AS name FROM supplier)
    SELECT coalesce(a.name, b.name) AS name,
           CASE WHEN a.name IS NULL THEN 'unexpected' WHEN b.name IS NULL THEN 'missing' ELSE 'common' END AS state
    FROM a FULL JOIN b ON a.name = b.name
    """,
)
def name_set_diff(spark, sf):
    a = table(spark, sf, "part").select(F.col("p_brand").alias("name"))
    b = table(spark, sf, "supplier").select(F.concat(F.lit("Brand#"), F.col("s_suppkey").cast("string")).alias("name"))
    return sets.schema_set_diff(a, b)


ORDER_RULES = RuleSet(
    critical=("customer", "priority"),
    valid_values={"status": ("O", "F")},
    ranges={"total": (50000, 400000)},
    consistency=(When("status", "F", "priority"),),
    formats={"priority": r"^\d-[A-Z ]+$"},
    expressions={"created_before": "created <= DATE'2001-01-01'"},
)


def checked_orders(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_custkey") > 100, F.col("o_custkey")).alias("customer"),
        F.when(F.col("o_totalprice") < 450000, F.col("o_orderpriority")).alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").cast("date").alias("created"),
    )
    return quality.check(o, ORDER_RULES)


_CHECKED = """
    o AS (SELECT o_orderkey AS id, CASE WHEN o_custkey > 100 THEN o_custkey END AS customer,
                 CASE WHEN o_totalprice < 450000 THEN o_orderpriority END AS priority,
                 nullif(o_orderstatus, 'O') AS status, o_totalprice AS total, o_orderdate::DATE AS created FROM orders),
    r AS (SELECT *, customer IS NOT NULL AND priority IS NOT NULL AS c1, coalesce(status IN ('O', 'F'), TRUE) AS c2,
                 total >= 50000 AND total <= 400000 AS c3, coalesce(status <> 'F', TRUE) OR priority IS NOT NULL AS c4,
                 coalesce(regexp_matches(priority, '^\\d-[A-Z ]+$'), TRUE) AS c5, created <= DATE '2001-01-01' AS c6 FROM o),
    q AS (SELECT *, c1 AND c2 AND c3 AND c4 AND c5 AND c6 AS _quality_valid,
                 concat(CASE WHEN NOT c1 THEN 'COMPLETENESS_FAIL;' END, CASE WHEN NOT c2 THEN 'VALIDITY_FAIL;' END,
                        CASE WHEN NOT c3 THEN 'RANGE_FAIL;' END, CASE WHEN NOT c4 THEN 'CONSISTENCY_FAIL;' END,
                        CASE WHEN NOT c5 THEN 'FORMAT_FAIL;' END, CASE WHEN NOT c6 THEN 'RULE_FAIL;' END) AS _quality_issues
          FROM r)
"""


@query("quality_flags", f"WITH {_CHECKED} SELECT id, customer, status, _quality_valid, _quality_issues FROM q")
def quality_flags(spark, sf):
    return checked_orders(spark, sf).select("id", "customer", "status", "_quality_valid", "_quality_issues")


@query(
    "quality_gate_score",
    f"""
    WITH {_CHECKED} SELECT count(*) AS total, count(*) FILTER (WHERE _quality_valid) AS valid,
      CAST(count(*) FILTER (WHERE _quality_valid) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS score FROM q
    """,
)
def quality_gate_score(spark, sf):
    return quality.score(checked_orders(spark, sf))


@query(
    "quality_issues",
    f"""
    WITH {_CHECKED},
    f AS (SELECT id, 'completeness:customer' AS rule, 'customer is null' AS msg FROM r WHERE customer IS NULL
      UNION ALL SELECT id, 'completeness:priority', 'priority is null' FROM r WHERE priority IS NULL
      UNION ALL SELECT id, 'validity:status', 'status not an allowed value' FROM r WHERE NOT c2
      UNION ALL SELECT id, 'range:total', 'total out of range' FROM r WHERE NOT c3
      UNION ALL SELECT id, 'consistency:priority', 'priority required when status is F' FROM r WHERE NOT c4
      UNION ALL SELECT id, 'format:priority', 'priority wrong format' FROM r WHERE NOT c5
      UNION ALL SELECT id, 'expression:created_before', 'created_before created <= DATE''2001-01-01''' FROM r WHERE NOT c6)
    SELECT md5('orders|' || id || '|' || rule) AS issue_id, 'orders' AS table_name, CAST(id AS VARCHAR) AS record_id,
           rule AS validation_rule, msg AS error_message FROM f
    """,
)
def quality_issues(spark, sf):
    rows = checked_orders(spark, sf)
    out = quality.issue_rows(rows, ORDER_RULES, "orders", "id", F.lit("2002-01-01").cast("timestamp_ntz"))
    return out.drop("timestamp")


@query(
    "layer_rules",
    """
    SELECT o_orderkey AS id, t > 0 AND created <= DATE '2001-06-01' AND
           abs(t - (i + s - d)) < 0.005 AND modified >= created AND changes >= 1 AS _quality_valid
    FROM (SELECT *, o_orderdate::DATE AS created, (o_orderdate + to_days(o_custkey % 5 - 1))::DATE AS modified,
                 o_custkey % 4 AS changes, o_totalprice AS t, o_totalprice - 10 AS i,
                 CASE WHEN o_orderstatus = 'P' THEN 12 ELSE 15 END AS s, 5 AS d FROM orders)
    """.replace("to_days(o_custkey % 5 - 1)", "to_days(CAST(o_custkey % 5 - 1 AS INTEGER))"),
)
def layer_rules(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("total_amount"),
        (F.col("o_totalprice") - 10).alias("items_amount"),
        F.when(F.col("o_orderstatus") == "P", 12).otherwise(15).alias("shipping_amount"),
        F.lit(5).alias("discounts_amount"),
        F.col("o_orderdate").cast("date").alias("date_created"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_custkey") % 5 - 1).cast("int")).alias("date_modified"),
        (F.col("o_custkey") % 4).alias("total_changes"),
        F.lit("2001-06-01").cast("date").alias("as_of"),
    )
    rules = RuleSet(expressions={**quality.SILVER_RULES, **quality.GOLD_RULES})
    return quality.check(o, rules).select("id", "_quality_valid")


@query(
    "anomalies",
    """
    SELECT o_orderkey, z > 0 AS high FROM (
      SELECT o_orderkey, (o_totalprice - avg(o_totalprice) OVER w) / stddev_pop(o_totalprice) OVER w AS z
      FROM orders WINDOW w AS (PARTITION BY o_orderpriority))
    WHERE abs(z) > 1.5
    """,
)
def anomalies(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = quality.anomalies(o, "o_totalprice", ["o_orderpriority"], 1.5)
    return out.select("o_orderkey", (F.col("z_score") > 0).alias("high"))


@query(
    "dead_letter_split",
    f"""
    WITH {_CHECKED} SELECT id, _quality_issues AS _dlq_reason, '2002-01-01 00:00:00' AS _dlq_timestamp
    FROM q WHERE NOT _quality_valid
    """,
)
def dead_letter_split(spark, sf):
    letters = errors.dead_letters(checked_orders(spark, sf), F.lit("2002-01-01").cast("timestamp_ntz"))
    return letters.select(
        "id", "_dlq_reason", F.date_format("_dlq_timestamp", "yyyy-MM-dd HH:mm:ss").alias("_dlq_timestamp")
    )


@query(
    "recovery_modes",
    f"""
    WITH {_CHECKED} SELECT 'flag' AS mode, NOT _quality_valid AS _error_handled, count(*) AS rows FROM q GROUP BY 2
    UNION ALL SELECT 'exclude', TRUE, count(*) FROM q WHERE _quality_valid
    """,
)
def recovery_modes(spark, sf):
    rows = checked_orders(spark, sf)
    out = None
    for mode in ("flag", "exclude"):
        part = errors.split_bad(rows, mode).groupBy(F.lit(mode).alias("mode"), "_error_handled").agg(
            F.count(F.lit(1)).alias("rows")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "row_hash",
    """
    SELECT c_custkey, md5(concat_ws('|', c_custkey, c_name, c_nationkey, nullif(c_mktsegment, 'BUILDING'))) AS
      _lineage_record_hash, 'p1' AS _lineage_pipeline_id, 'silver' AS _lineage_source,
      md5(concat_ws('|', c_custkey, c_name, c_nationkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '~'))) AS strict_hash
    FROM customer
    """,
)
def row_hash(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment")
    )
    tagged = lineage.add_lineage(rows, "p1", "silver", F.lit("2002-01-01").cast("timestamp_ntz"))
    return tagged.withColumn("strict_hash", lineage.row_hash(rows, "~")).select(
        "c_custkey", "_lineage_record_hash", "_lineage_pipeline_id", "_lineage_source", "strict_hash"
    )


@query(
    "hash_changes",
    """
    WITH n AS (SELECT CASE WHEN c_nationkey = 3 THEN c_custkey + 10000000 ELSE c_custkey END AS id, c_name AS name,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSE' ELSE c_mktsegment END AS segment FROM customer),
    o AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer)
    SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END
      AS change FROM o FULL JOIN n ON o.id = n.id
    WHERE o.id IS NULL OR n.id IS NULL OR o.name <> n.name OR o.segment <> n.segment
    """,
)
def hash_changes(spark, sf):
    c = table(spark, sf, "customer")
    old = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    new = c.select(
        F.when(F.col("c_nationkey") == 3, F.col("c_custkey") + 10000000).otherwise(F.col("c_custkey")).alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "HOUSE").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    return lineage.hash_changes(old, new, ["id"])


@query(
    "incremental_slice",
    "SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'",
)
def incremental_slice(spark, sf):
    e = table(spark, sf, "events")
    return incremental.since(e, "ts", "2024-01-20 12:00:00").select("event_id", "event_type")


@query(
    "overlap_slice",
    "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 20 MINUTE",
)
def overlap_slice(spark, sf):
    last = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return incremental.overlapping(table(spark, sf, "events"), "ts", last, 20).select("event_id")


@query(
    "latest_modified",
    "SELECT max(coalesce(CASE WHEN event_type = 'view' THEN event_id END, user_id)) AS watermark FROM events",
)
def latest_modified(spark, sf):
    e = table(spark, sf, "events").select(
        F.when(F.col("event_type") == "view", F.col("event_id")).alias("dateModified"),
        F.col("user_id").alias("modified_at"),
    )
    return incremental.next_watermark(e, list(incremental.MODIFIED_FIELDS))


@query(
    "slowest_runs",
    """
    SELECT event_id, value AS duration_seconds FROM events ORDER BY value DESC, event_id LIMIT 25
    """,
)
def slowest_runs(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("value").alias("duration_seconds"))
    return lineage.slowest(e, 25)


@query(
    "layer_counts",
    """
    WITH c AS (SELECT 0 AS position, 'bronze' AS layer, count(*) AS rows FROM lineitem
               UNION ALL SELECT 1, 'silver', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
               UNION ALL SELECT 2, 'gold', count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem))
    SELECT a.position, a.layer, a.rows, b.rows AS rows_before,
           CAST(a.rows AS DOUBLE) / CAST(b.rows AS DOUBLE) AS kept_share
    FROM c a LEFT JOIN c b ON a.position = b.position + 1
    """,
)
def layer_counts(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return validate.reconcile(
        {"bronze": lines, "silver": lines.distinct(), "gold": lines.select("l_orderkey").distinct()}
    )


@query(
    "source_comparison",
    """
    SELECT 'orders' AS source, count(*) AS records, CAST(strftime(min(o_orderdate), '%Y%m%d') AS INTEGER) AS earliest,
           CAST(strftime(max(o_orderdate), '%Y%m%d') AS INTEGER) AS latest FROM orders
    UNION ALL SELECT 'lines', count(*), CAST(strftime(min(l_shipdate), '%Y%m%d') AS INTEGER),
           CAST(strftime(max(l_shipdate), '%Y%m%d') AS INTEGER) FROM lineitem
    """,
)
def source_comparison(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderdate").alias("at"))
    lines = table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("at"))
    metrics = [
        F.count(F.lit(1)).alias("records"), clock.day_key(F.min("at")).alias("earliest"),
        clock.day_key(F.max("at")).alias("latest"),
    ]
    return validate.compare_sources({"orders": o, "lines": lines}, metrics)


@query(
    "metric_comparison",
    """
    SELECT 'open' AS source, CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0 AS revenue,
           count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS products
    FROM lineitem WHERE l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '2000-01-01'
    UNION ALL
    SELECT 'closed', CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0,
           count(DISTINCT l_orderkey), count(DISTINCT l_partkey)
    FROM lineitem WHERE l_linestatus = 'F' AND l_shipdate >= TIMESTAMP '2000-01-01'
    """,
)
def metric_comparison(spark, sf):
    recent = table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    metrics = [
        (F.sum(minor(F.col("l_extendedprice")).cast("decimal(18,0)")).cast("double") / 100.0).alias("revenue"),
        F.count_distinct("l_orderkey").alias("orders"),
        F.count_distinct("l_partkey").alias("products"),
    ]
    return validate.compare_sources(
        {"open": recent.filter("l_linestatus = 'O'"), "closed": recent.filter("l_linestatus = 'F'")}, metrics
    )


@query(
    "missing_either_side",
    """
    WITH a AS (SELECT DISTINCT c_custkey + 40 AS id FROM customer), b AS (SELECT DISTINCT user_id AS id FROM events)
    SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'missing in events' ELSE 'missing in customers' END AS issue
    FROM a FULL JOIN b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL
    """,
)
def missing_either_side(spark, sf):
    a = table(spark, sf, "customer").select((F.col("c_custkey") + 40).alias("id"))
    b = table(spark, sf, "events").select(F.col("user_id").alias("id"))
    return validate.missing_either_side(a, b, "id", ("customers", "events"))
