"""Several runs over one table: totals that accumulate, gates that hold back, rules over groups of rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tributary.config import AggSpec, ColumnSpec, FieldMap, GoldSpec, Metric, RuleSet, TableSpec
from tributary.functions import clock, parse
from tributary.functions.money import minor
from tributary.operators import lineage, mapping, nested, quality, tables, type_plan, validate
from tributary.plans.layers import publish, to_gold
from tributary.plans.registry import query, table
from tributary.session import materialize, scratch_path
from tributary.sources import readers, writers

AT = "2002-01-01"


def _now():
    return F.lit(AT).cast("timestamp_ntz")


def _sold(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return table(spark, sf, "orders").withColumn("amount", minor(F.col("o_totalprice"))).join(c, "o_custkey")


TOTALS = GoldSpec(
    table="branch_totals",
    field_map=(
        FieldMap("branch", "c_nationkey", "bigint_to_string"),
        FieldMap("priority", "o_orderpriority"),
        FieldMap("amount", "amount"),
        FieldMap("buyer", "o_custkey"),
        FieldMap("state", "o_orderstatus"),
    ),
    timestamp_column="o_orderdate",
    aggregate=AggSpec(
        ("branch", "priority"),
        (Metric("amount", ("sum", "avg", "min", "max")), Metric("buyer", ("count_distinct",)), Metric("state", ("count_distinct",)), Metric("*", ("count",))),
    ),
)


@query(
    "incremental_totals",
    """
    SELECT CAST(c_nationkey AS VARCHAR) AS branch, o_orderpriority AS priority, CAST(sum(x) AS BIGINT) AS total_amount,
           CAST(sum(x) AS DOUBLE) / count(x) AS promedio_amount, min(x) AS min_amount, max(x) AS max_amount,
           count(DISTINCT o_custkey) AS distintos_buyer, count(DISTINCT o_orderstatus) AS distintos_state, count(*) AS num_registros
    FROM (SELECT *, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS x FROM orders) JOIN customer ON c_custkey = o_custkey
    GROUP BY 1, 2
    """,
)
def incremental_totals(spark, sf):
    """Two halves, the second of them run twice, equal one full run; buyers of both halves count once."""
    sold, kept = _sold(spark, sf), scratch_path(spark, "totals")
    half = F.lit("1995-06-17").cast("timestamp_ntz")
    to_gold(sold.filter(F.col("o_orderdate") <= half), TOTALS, _now(), totals=kept, run="first")
    for _ in range(2):
        gold = to_gold(sold, TOTALS, _now(), half, totals=kept, run="second")
    return gold.rows.drop("_quality_valid", "_quality_issues", "_error_handled")


def _gated(threshold: float) -> GoldSpec:
    return GoldSpec(
        table="orders",
        field_map=(FieldMap("id", "o_orderkey"), FieldMap("state", "o_orderstatus"), FieldMap("priority", "o_orderpriority")),
        rules=RuleSet(valid_values={"state": ("F", "O")}, threshold=threshold),
        recovery="exclude",
    )


@query(
    "gate_publish",
    """
    SELECT 'gold' AS place, o_orderkey AS id, o_orderstatus AS state, NULL::VARCHAR AS reason FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'letters', o_orderkey, o_orderstatus, 'VALIDITY_FAIL;' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'evidence', o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'VALIDITY_FAIL;' ELSE '' END FROM orders
    """,
)
def gate_publish(spark, sf):
    """A run that passes is published with its dead letters; one that fails leaves both alone and keeps its rows."""
    orders, gold_path, letters = table(spark, sf, "orders"), scratch_path(spark, "gold"), scratch_path(spark, "letters")
    urgent = orders.filter("o_orderpriority = '1-URGENT'")
    publish(to_gold(urgent, _gated(0.6), _now()), gold_path, letters, "passes")
    try:
        publish(to_gold(orders, _gated(0.9), _now()), gold_path, letters, "fails")
        raise AssertionError("the gate should have held this run back")
    except quality.GateError as held:
        evidence = readers.read_parquet(spark, held.evidence)
    schema = "id bigint, state string, _dlq_reason string"
    parts = {
        "gold": readers.read_parquet(spark, gold_path).withColumn("reason", F.lit(None).cast("string")),
        "letters": readers.read_dead_letters(spark, letters, schema).withColumn("reason", F.col("_dlq_reason")),
        "evidence": evidence.withColumn("reason", F.col("_quality_issues")),
    }
    out = [df.select(F.lit(n).alias("place"), "id", "state", "reason") for n, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


LINES = TableSpec(
    "lines",
    {
        "order_id": ColumnSpec("BIGINT", nullable=False, primary_key=True, source_field="x"),
        "part_id": ColumnSpec("BIGINT", nullable=False, primary_key=True, source_field="y"),
        "quantity": ColumnSpec("INT", source_field="z"),
    },
)


@query(
    "rules_from_schema",
    """
    WITH l AS (SELECT l_orderkey AS order_id, l_partkey AS part_id, l_linenumber AS line, CAST(l_quantity AS INTEGER) - 2 AS quantity,
                      count(*) OVER (PARTITION BY l_orderkey, l_partkey) > 1 AS again FROM lineitem)
    SELECT order_id, part_id, line, quantity, NOT again AND quantity >= 0 AS _quality_valid,
           concat(CASE WHEN quantity < 0 THEN 'RANGE_FAIL;' END, CASE WHEN again THEN 'UNIQUENESS_FAIL;' END) AS _quality_issues
    FROM l
    """,
)
def rules_from_schema(spark, sf):
    """Primary key and ranges as the table's description implies them; every row of a repeated key is marked."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"), F.col("l_linenumber").alias("line"),
        (F.col("l_quantity").cast("int") - 2).alias("quantity"),
    )
    return quality.check(lines, quality.rules_from_table(LINES))


@query(
    "unique_per_client",
    """
    SELECT client_id, id, line, 'client_id,id is repeated' AS error_message
    FROM (SELECT *, count(*) OVER (PARTITION BY client_id, id) AS n
          FROM (SELECT l_returnflag AS client_id, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_orderkey END AS id,
                       CAST(l_linenumber AS BIGINT) AS line FROM lineitem))
    WHERE n > 1 AND id IS NOT NULL
    """,
)
def unique_per_client(spark, sf):
    """Issue rows of ids that occur twice within a client; the same id of another client is none, nor is a null."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("client_id"), F.when(F.col("l_suppkey") % 7 != 0, F.col("l_orderkey")).alias("id"), "l_linenumber"
    )
    marked = lines.withColumn("record", F.concat_ws("|", "client_id", F.col("id").cast("string"), F.col("l_linenumber").cast("string")))
    found = quality.issue_rows(marked, RuleSet(unique=(quality.unique_per_client("id"),)), "lines", "record", _now())
    parts = F.split("record_id", "\\|")
    return found.select(
        parts[0].alias("client_id"), parts[1].cast("bigint").alias("id"), parts[2].cast("bigint").alias("line"), "error_message"
    )


@query(
    "type_plan_runs",
    """
    SELECT event_id, 'second' AS run, CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS buyer,
           CASE WHEN event_id % 50 = 0 THEN '{"buyer":"U' || user_id || '"}' END AS kept, 'int' AS plan FROM events
    UNION ALL
    SELECT event_id, 'third', CASE WHEN event_id % 50 = 0 THEN 'U' || user_id ELSE CAST(user_id AS VARCHAR) END, NULL, 'string' FROM events
    """,
)
def type_plan_runs(spark, sf):
    """The first run profiles; the second converts by its plan and keeps what does not fit; the third has the wider plan."""
    path = scratch_path(spark, "types")
    buyer = F.col("user_id").cast("string")
    first = table(spark, sf, "events").select("event_id", buyer.alias("buyer"))
    later = first.withColumn("buyer", F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("U"), "buyer")).otherwise(F.col("buyer")))
    type_plan.typed(first, path, "first")
    out = None
    for run in ("second", "third"):
        plan = type_plan.load(spark, path)
        rows = materialize(type_plan.typed(later, path, run), "typed")
        type_plan.learn(rows, path, run)
        one = rows.select(
            "event_id", F.lit(run).alias("run"), F.col("buyer").cast("string").alias("buyer"), F.col(type_plan.UNTYPED).alias("kept"),
            F.lit(plan["buyer"]).alias("plan"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "stage_durations",
    """
    WITH c AS (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R') AS b,
                      (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_returnflag <> 'R') AS d)
    SELECT run, stage, records_in, records_out, true AS measured, true AS in_order FROM c, (VALUES ('a'), ('b')) v(run),
      LATERAL (VALUES ('read', a, a), ('filter', a, b), ('group', b, d)) s(stage, records_in, records_out)
    """,
)
def stage_durations(spark, sf):
    """Two runs with a clock around every staged write; the reports are written, read back and ranked by duration."""
    path = scratch_path(spark, "reports")
    for run in ("a", "b"):
        meter = lineage.StageMeter("sales")
        df = meter.timed(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"), "read")
        df = meter.timed(df.filter("l_returnflag <> 'R'"), "filter")
        meter.timed(df.groupBy("l_orderkey").count(), "group")
        lineage.write_report(meter.report(spark, _now()), path, run)
    reports = lineage.read_reports(spark, path)
    ranked = lineage.slowest(reports, 6).withColumn("place", F.monotonically_increasing_id())
    before = F.lag("duration_seconds").over(Window.orderBy("place"))
    return ranked.select(
        "run", "stage", "records_in", "records_out", (F.col("duration_seconds") > 0).alias("measured"),
        (before.isNull() | (before >= F.col("duration_seconds"))).alias("in_order"),
    )


@query(
    "compact_partitioned",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows, true AS fewer_files, true AS large_left_alone FROM orders GROUP BY 1
    """,
)
def compact_partitioned(spark, sf):
    """Many small files a year and one larger one: the small ones are packed, the larger one keeps its name and size."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    source, target = scratch_path(spark, "many"), scratch_path(spark, "packed")
    large, rest = o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1")
    large.repartition("year").write.partitionBy("year").parquet(source)
    limit = tables.data_files(spark, source).agg(F.min("bytes")).first()[0]
    rest.repartition(8).write.mode("append").partitionBy("year").parquet(source)
    before = materialize(tables.data_files(spark, source, ["year"]), "files")
    plan = tables.compact_partitioned(spark, source, target, ["year"], 2 * limit, limit)
    # What a reader sees afterwards: the files that no bin took, with their old sizes, and the packed ones.
    kept = before.join(plan, "file", "left_anti").withColumn("packed", F.lit(False))
    after = kept.unionByName(tables.data_files(spark, target, ["year"]).withColumn("packed", F.lit(True)))
    counts = after.groupBy("year").agg(F.count(F.lit(1)).alias("now")).join(before.groupBy("year").agg(F.count(F.lit(1)).alias("was")), "year")
    alone = kept.filter(F.col("bytes") >= limit).groupBy("year").agg((F.count(F.lit(1)) == 1).alias("large_left_alone"))
    whole = readers.read_parquet(spark, source).withColumn("_file", F.col("_metadata.file_path")).join(plan, F.col("_file") == F.col("file"), "left_anti")
    rows = whole.select("year").unionByName(readers.read_parquet(spark, target).select("year")).groupBy("year").agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(counts, "year").join(alone, "year").select("year", "rows", (F.col("now") < F.col("was")).alias("fewer_files"), "large_left_alone")


@query(
    "table_append",
    """
    SELECT o_orderkey, o_orderpriority, 'json' AS sink FROM orders
    UNION ALL SELECT o_orderkey, o_orderpriority, 'append' FROM orders
    """,
)
def table_append(spark, sf):
    """Two halves appended to one partitioned table, and the whole written as one JSON file and overwritten."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    path, text = scratch_path(spark, "appended"), scratch_path(spark, "json")
    for half in ("o_orderpriority <= '2-HIGH'", "o_orderpriority > '2-HIGH'"):
        writers.append(o.filter(half), path, ["o_orderpriority"])
    writers.write_json(o.limit(0), text)
    writers.write_json(o, text, single_file=True)
    if spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(text).count() != 1:
        raise ValueError("one JSON file expected")
    back = spark.read.schema("o_orderkey bigint, o_orderpriority string").json(text).withColumn("sink", F.lit("json"))
    return back.unionByName(readers.read_parquet(spark, path).withColumn("sink", F.lit("append")))


@query(
    "epoch_and_precision",
    """
    SELECT event_id, CASE WHEN s BETWEEN 0 AND 4102444800 THEN strftime(TIMESTAMP '1970-01-01' + to_seconds(s), '%Y-%m-%d %H:%M:%S') END AS iso,
           s BETWEEN 0 AND 4102444800 AS in_range, CASE WHEN NOT over THEN CAST(r AS VARCHAR) END AS price, over AS overflows
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN -1 - event_id ELSE epoch_us(ts) // 1000000 END AS s,
                 CAST(CAST(user_id AS DECIMAL(18,0)) * 1.25 AS DECIMAL(18,1)) AS r,
                 abs(CAST(CAST(user_id AS DECIMAL(18,0)) * 1.25 AS DECIMAL(18,1))) >= 1000 AS over FROM events)
    """,
)
def epoch_and_precision(spark, sf):
    """Epochs out of range and numbers with too many digits are told apart from good ones, row by row."""
    epoch = F.when(F.col("event_type") == "error", -1 - F.col("event_id")).otherwise(clock.to_epoch(F.col("ts")))
    price = F.col("user_id").cast("decimal(18,0)") * F.lit("1.25").cast("decimal(3,2)")
    rows = table(spark, sf, "events").select("event_id", epoch.alias("s"), price.alias("p"))
    good = clock.epoch_in_range(F.col("s"))
    return rows.select(
        "event_id", F.when(good, F.date_format(clock.epoch_to_utc(F.col("s")), "yyyy-MM-dd HH:mm:ss")).alias("iso"), good.alias("in_range"),
        parse.decimal_of(F.col("p"), 4, 1).cast("string").alias("price"), parse.decimal_overflows(F.col("p"), 4, 1).alias("overflows"),
    )


@query(
    "lineage_columns",
    """
    SELECT o_orderkey, 'run-7' AS _lineage_pipeline_id, 'orders' AS _lineage_source, '2002-01-01 00:00:00' AS _lineage_timestamp,
           md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), o_orderstatus)) AS _lineage_record_hash
    FROM orders
    """,
)
def lineage_columns(spark, sf):
    """Pipeline, source, time and hash beside every row."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    out = lineage.add_lineage(o, "run-7", "orders", _now()).drop("o_orderstatus")
    return out.withColumn("_lineage_timestamp", F.date_format("_lineage_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query(
    "mapping_failures",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN '1970-01-01 00:00:' || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') END AS at,
           CASE WHEN o_orderstatus = 'O' THEN true END AS flag, 0::BIGINT AS pairs
    FROM orders
    """,
)
def mapping_failures(spark, sf):
    """Text that is no epoch or flag makes the field null and leaves the row; a column that is no object has no pairs."""
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", (F.col("o_custkey") % 60).cast("string")).otherwise("soon").alias("created"),
        F.when(F.col("o_orderstatus") == "O", "1").otherwise("maybe").alias("gift"),
    )
    maps = [FieldMap("id", "id"), FieldMap("at", "created", "timestamp_to_iso8601"), FieldMap("flag", "gift", "tinyint_to_boolean")]
    out = mapping.map_schema(raw, maps).withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
    none = nested.key_value_table(raw, "created").groupBy("id").agg(F.count(F.lit(1)).alias("pairs"))
    return out.join(none, "id", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0).cast("bigint")))


@query(
    "layer_quality_score",
    """
    SELECT CAST(count(*) FILTER (WHERE n > 0) + count(*) FILTER (WHERE n > 0 AND good) AS DOUBLE) / (2 * count(*)) AS score
    FROM (SELECT (SELECT count(*) FROM orders) AS n, true AS good UNION ALL SELECT (SELECT count(*) FROM customer), false
          UNION ALL SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'X'), true)
    """,
)
def layer_quality_score(spark, sf):
    """Half for tables that hold rows, half for those whose columns are as described: one is empty, one is wrong."""
    wanted = TableSpec("t", {"o_orderkey": ColumnSpec("BIGINT", source_field="x"), "o_orderstatus": ColumnSpec("VARCHAR(1)", source_field="y")})
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables_ = {"orders": o, "customers": table(spark, sf, "customer").select("c_custkey"), "none": o.filter("o_orderstatus = 'X'")}
    existing = [n for n, df in tables_.items() if not df.isEmpty()]
    valid = [n for n in existing if validate.validate(tables_[n], wanted).filter("`check` = 'schema' and status = 'FAIL'").isEmpty()]
    return spark.range(1).select(F.lit(validate.quality_score(len(existing), len(valid), len(tables_))).alias("score"))
