"""Cleaning, normalizing, parsing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import clock, parse, text
from tributary.functions.money import minor
from tributary.operators import clean, sets, typing
from tributary.plans.registry import query, table


@query(
    "clean_strings",
    """
    WITH raw AS (
      SELECT c_custkey, '  ' || c_name || ' ' AS name,
             CASE WHEN c_nationkey = 3 THEN '   ' ELSE c_mktsegment || ' ' END AS segment,
             c_name || chr(128512) AS note
      FROM customer)
    SELECT c_custkey, nullif(trim(name), '') AS name, nullif(trim(segment), '') AS segment,
           regexp_replace(nullif(trim(note), ''), '[^\\x{0000}-\\x{FFFF}]', '?', 'g') AS note
    FROM raw
    """,
)
def clean_strings(spark, sf):
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("name"),
        F.when(F.col("c_nationkey") == 3, "   ").otherwise(F.concat("c_mktsegment", F.lit(" "))).alias("segment"),
        F.concat("c_name", F.lit("\U0001f600")).alias("note"),
    )
    return clean.clean(raw)


@query(
    "clean_documents",
    """
    SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS chars
    FROM (SELECT doc_id, regexp_replace(nullif(trim(text), ''), '[^\\x{0000}-\\x{FFFF}]', '?', 'g') AS t
          FROM documents)
    """,
)
def clean_documents(spark, sf):
    cleaned = clean.clean(table(spark, sf, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


@query(
    "clean_null_tokens",
    """
    WITH raw AS (
      SELECT event_id,
             CASE event_type WHEN 'view' THEN ' NULL ' WHEN 'click' THEN 'null'
                  WHEN 'error' THEN chr(9) || event_type || chr(13) || chr(10) || 'x' || chr(7)
                  ELSE event_type || chr(10) END AS note
      FROM events)
    SELECT event_id,
           CASE WHEN lower(trim(n)) = 'null' THEN NULL ELSE nullif(trim(n), '') END AS note
    FROM (SELECT event_id, regexp_replace(regexp_replace(regexp_replace(note, '\\r\\n?', chr(10), 'g'),
            '[\\x00-\\x08\\x0B-\\x1F\\x7F]', '', 'g'), '^\\s+|\\s+$', '', 'g') AS n FROM raw)
    """,
)
def clean_null_tokens(spark, sf):
    kind = F.col("event_type")
    note = (
        F.when(kind == "view", " NULL ")
        .when(kind == "click", "null")
        .when(kind == "error", F.concat(F.lit("\t"), kind, F.lit("\r\nx\x07")))
        .otherwise(F.concat(kind, F.lit("\n")))
    )
    raw = table(spark, sf, "events").select("event_id", note.alias("note"))
    return clean.clean(raw, null_tokens=("null",), drop_controls=True)


@query(
    "normalize_contacts",
    r"""
    WITH raw AS (
      SELECT c_custkey,
             CASE WHEN c_nationkey < 5 THEN 'no mail' ELSE '  User' || c_custkey || '@Example.COM ' END AS email,
             CASE WHEN c_nationkey = 7 THEN 'none'
                  WHEN c_nationkey < 12 THEN '(01) 234-' || c_custkey ELSE '+51 987 ' || c_custkey END AS phone,
             lower(c_mktsegment) || '   o''neil  ' || c_name AS label
      FROM customer)
    SELECT c_custkey, lower(email) AS email_lower,
           CASE WHEN regexp_matches(lower(trim(email)), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')
                THEN lower(trim(email)) END AS email,
           regexp_replace(phone, '[^0-9]', '', 'g') AS phone_digits,
           CASE WHEN d = '' THEN NULL WHEN starts_with(d, '51') THEN '+' || d ELSE '+51' || d END AS phone,
           trim(regexp_replace(label, '\s+', ' ', 'g')) AS label,
           upper(label) AS label_upper
    FROM (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS d FROM raw)
    """,
)
def normalize_contacts(spark, sf):
    nation, key = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    email = F.when(nation < 5, "no mail").otherwise(F.concat(F.lit("  User"), key, F.lit("@Example.COM ")))
    phone = (
        F.when(nation == 7, "none")
        .when(nation < 12, F.concat(F.lit("(01) 234-"), key))
        .otherwise(F.concat(F.lit("+51 987 "), key))
    )
    label = F.concat(F.lower("c_mktsegment"), F.lit("   o'neil  "), "c_name")
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        email.alias("email_lower"),
        email.alias("email"),
        phone.alias("phone_digits"),
        phone.alias("phone"),
        label.alias("label"),
        label.alias("label_upper"),
    )
    rules = clean.contact_rules(emails=["email_lower"], phones=["phone_digits"])
    rules |= {
        "email": {"type": "email"},
        "phone": {"type": "phone"},
        "label": {"type": "remove_extra_spaces"},
        "label_upper": {"type": "case", "params": {"case": "upper"}},
    }
    return clean.normalize(raw, rules)


@query(
    "title_case",
    r"""
    SELECT p_partkey, array_to_string(list_transform(
             regexp_extract_all(replace(p_name, ' ', '''') || ' ' || p_type, '[A-Za-z]+|[^A-Za-z]+'),
             lambda r: upper(r[1:1]) || lower(r[2:])), '') AS title
    FROM part
    """,
)
def title_case(spark, sf):
    raw = F.concat(F.regexp_replace("p_name", " ", "'"), F.lit(" "), "p_type")
    return table(spark, sf, "part").select("p_partkey", text.title_case(raw).alias("title"))


@query(
    "parse_dates",
    """
    WITH raw AS (
      SELECT event_id,
             CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d') WHEN 'click' THEN strftime(ts, '%d/%m/%Y')
                  WHEN 'purchase' THEN strftime(ts, '%Y/%m/%d') WHEN 'signup' THEN strftime(ts, '%m/%d/%Y')
                  ELSE 'soon' END AS d,
             CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                  WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                  WHEN 'purchase' THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
                  WHEN 'signup' THEN strftime(ts, '%m/%d/%Y %H:%M:%S') ELSE '' END AS t
      FROM events)
    SELECT event_id,
           strftime(coalesce(try_strptime(d, '%Y-%m-%d'), try_strptime(d, '%d/%m/%Y'),
                             try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%Y/%m/%d')), '%Y-%m-%d') AS day,
           strftime(coalesce(try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%Y-%m-%dT%H:%M:%S'),
                             try_strptime(t, '%d/%m/%Y %H:%M:%S'), try_strptime(t, '%m/%d/%Y %H:%M:%S')),
                    '%Y-%m-%d %H:%M:%S') AS moment
    FROM raw
    """,
)
def parse_dates(spark, sf):
    kind = F.col("event_type")

    def spelled(view, click, purchase, signup, other):
        return (
            F.when(kind == "view", F.date_format("ts", view))
            .when(kind == "click", F.date_format("ts", click))
            .when(kind == "purchase", F.date_format("ts", purchase))
            .when(kind == "signup", F.date_format("ts", signup))
            .otherwise(other)
        )

    days = spelled("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "MM/dd/yyyy", "soon")
    times = spelled("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "")
    raw = table(spark, sf, "events").select("event_id", days.alias("day"), times.alias("moment"))
    typed = typing.apply_types(raw, {"day": "date", "moment": "timestamp"})
    return typed.select(
        "event_id",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"),
    )


@query(
    "bool_text",
    """
    WITH raw AS (
      SELECT c_custkey,
             CASE c_nationkey WHEN 0 THEN 'TRUE' WHEN 1 THEN 'No' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN 'y'
                  WHEN 5 THEN 'F' WHEN 6 THEN NULL WHEN 7 THEN 'maybe' ELSE 'yes' END AS w, c_nationkey AS n
      FROM customer)
    SELECT c_custkey,
           CASE WHEN lower(w) IN ('true', '1', 'yes', 'y', 't') THEN TRUE
                WHEN lower(w) IN ('false', '0', 'no', 'n', 'f') THEN FALSE END AS word,
           CASE n WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS flag_01, n <> 0 AS flag_nonzero
    FROM raw
    """,
)
def bool_text(spark, sf):
    n = F.col("c_nationkey")
    words = {0: "TRUE", 1: "No", 2: "1", 3: "0", 4: "y", 5: "F", 6: None, 7: "maybe"}
    word = F.lit("yes")
    for code, value in words.items():
        word = F.when(n == code, F.lit(value)).otherwise(word)
    return table(spark, sf, "customer").select(
        "c_custkey",
        parse.bool_text(word).alias("word"),
        parse.flag_01(n).alias("flag_01"),
        parse.flag_nonzero(n).alias("flag_nonzero"),
    )


@query(
    "convert_types",
    """
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text,
           TRY_CAST(o_totalprice AS DECIMAL(8,2)) IS NULL AS overflows,
           CAST(CAST(o_totalprice AS DECIMAL(15,5)) AS DOUBLE) AS price,
           substring(o_orderpriority, 1, 5) AS priority,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created,
           CAST(o_custkey AS BIGINT) AS customer
    FROM orders
    """,
)
def convert_types(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").alias("key_text"),
        parse.decimal_overflows(F.col("o_totalprice"), 8, 2).alias("overflows"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("created"),
        F.col("o_custkey").cast("int").alias("customer"),
    )
    typed = typing.convert(
        o,
        {
            "key_text": {"type": "number_to_string"},
            "price": {"type": "decimal"},
            "priority": {"type": "varchar", "params": {"max_length": 5}},
            "created": {"type": "datetime_to_timestamp"},
            "customer": {"type": "int_to_bigint"},
        },
    )
    return typed.withColumn("price", F.col("price").cast("double"))


_INFER_COLUMNS = ("event_type", "props", "day", "moment", "buyer", "amount", "flag", "big")


def _infer_sql() -> str:
    one = """
    SELECT '{c}' AS "column", count({c}) AS filled,
      avg(CASE WHEN {c} IS NOT NULL THEN CAST(coalesce(lower(trim({c})) IN
          ('true','1','yes','y','t','false','0','no','n','f'), FALSE) AS INTEGER) END) AS b,
      avg(CASE WHEN {c} IS NOT NULL THEN CAST(coalesce(regexp_matches(trim({c}),
          '^(\\d{{4}}-\\d{{2}}-\\d{{2}}|\\d{{2}}/\\d{{2}}/\\d{{4}}|\\d{{4}}/\\d{{2}}/\\d{{2}})$')
          AND coalesce(try_strptime(trim({c}), '%Y-%m-%d'), try_strptime(trim({c}), '%d/%m/%Y'),
            try_strptime(trim({c}), '%m/%d/%Y'), try_strptime(trim({c}), '%Y/%m/%d')) IS NOT NULL, FALSE)
          AS INTEGER) END) AS d,
      avg(CASE WHEN {c} IS NOT NULL THEN CAST(regexp_matches(trim({c}),
          '^(\\d{{4}}-\\d{{2}}-\\d{{2}}(\\s+|T)|\\d{{2}}/\\d{{2}}/\\d{{4}}\\s+)\\d{{2}}:\\d{{2}}:\\d{{2}}')
          AS INTEGER) END) AS t,
      avg(CASE WHEN {c} IS NOT NULL THEN CAST(TRY_CAST(trim({c}) AS DOUBLE) IS NOT NULL AS INTEGER) END) AS n,
      bool_or(TRY_CAST(trim({c}) AS DOUBLE) IS NOT NULL AND (contains({c}, '.')
          OR TRY_CAST(trim({c}) AS DOUBLE) <> floor(TRY_CAST(trim({c}) AS DOUBLE)))) AS any_decimal,
      max(abs(TRY_CAST(trim({c}) AS DOUBLE))) AS max_abs
    FROM raw"""
    parts = " UNION ALL ".join(one.format(c=c) for c in _INFER_COLUMNS)
    return f"""
    WITH raw AS (
      SELECT event_type, props, strftime(ts, '%d/%m/%Y') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment,
             CAST(user_id AS VARCHAR) AS buyer, CAST(value AS VARCHAR) AS amount,
             CASE WHEN event_type = 'error' THEN NULL WHEN value > 20 THEN 'yes' ELSE 'no' END AS flag,
             CAST(event_id + 5000000000 AS VARCHAR) AS big
      FROM events),
    p AS ({parts})
    SELECT "column", filled, b AS boolean_share, d AS date_share, t AS timestamp_share, n AS number_share,
           CASE WHEN filled = 0 THEN 'string' WHEN b >= 0.9 THEN 'boolean' WHEN d >= 0.9 THEN 'date'
                WHEN t >= 0.9 THEN 'timestamp'
                WHEN n >= 0.9 THEN CASE WHEN any_decimal THEN 'decimal(18,2)' WHEN max_abs > 2147483647 THEN 'bigint'
                                        ELSE 'int' END
                ELSE 'string' END AS type
    FROM p
    """


@query("infer_types", _infer_sql())
def infer_types(spark, sf):
    raw = table(spark, sf, "events").select(
        "event_type",
        "props",
        F.date_format("ts", "dd/MM/yyyy").alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.col("user_id").cast("string").alias("buyer"),
        F.col("value").cast("string").alias("amount"),
        F.when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("value") > 20, "yes")
        .otherwise("no")
        .alias("flag"),
        (F.col("event_id") + 5000000000).cast("string").alias("big"),
    )
    return typing.inference_profile(raw).select(
        "column",
        "filled",
        F.col("boolean").alias("boolean_share"),
        F.col("date").alias("date_share"),
        F.col("timestamp").alias("timestamp_share"),
        F.col("number").alias("number_share"),
        typing.decided_type().alias("type"),
    )


@query(
    "infer_misfits",
    """
    SELECT event_id, 'mixed' AS "column", 'N/A-' || event_id AS value, 'int' AS type FROM events WHERE event_id % 20 = 0
    """,
)
def infer_misfits(spark, sf):
    text = F.col("event_id").cast("string")
    raw = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 20 == 0, F.concat(F.lit("N/A-"), text)).otherwise(text).alias("mixed")
    )
    return typing.misfits(raw, typing.infer_types(raw), ["event_id"])


@query(
    "infer_wide_numbers",
    """
    SELECT event_id, (event_id + 1) || '99999999999999999999' AS wide, event_id || '.12345' AS fine,
           CAST(event_id * 1000 AS DOUBLE) AS power, strftime(ts, '%Y-%m-%d') AS day,
           strftime(ts, '%Y-%m-%d %H:%M:%S') || '.123' AS fraction
    FROM events
    """,
)
def infer_wide_numbers(spark, sf):
    text = F.col("event_id").cast("string")
    raw = table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit(" "), (F.col("event_id") + 1).cast("string"), F.lit("99999999999999999999 ")).alias("wide"),
        F.concat(text, F.lit(".12345")).alias("fine"),
        F.concat(text, F.lit("e3")).alias("power"),
        F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd"), F.lit(" ")).alias("day"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".123")).alias("fraction"),
    )
    typed = typing.apply_types(raw, typing.infer_types(raw))
    exact = [F.col(c).cast("string").alias(c) for c in ("wide", "fine", "fraction")]
    return typed.select("event_id", exact[0], exact[1], "power", F.date_format("day", "yyyy-MM-dd").alias("day"), exact[2])


@query(
    "infer_leading_zeros",
    """
    SELECT event_id, lpad(CAST(user_id AS VARCHAR), 7, '0') AS code, '-0' || event_id AS signed, CAST(event_id AS INTEGER) AS plain,
           '0.' || event_id || '1' AS fraction
    FROM events
    """,
)
def infer_leading_zeros(spark, sf):
    """A zero before other digits is part of a name: such columns stay text, character by character."""
    key = F.col("event_id").cast("string")
    raw = table(spark, sf, "events").select(
        "event_id", F.lpad(F.col("user_id").cast("string"), 7, "0").alias("code"), F.concat(F.lit("-0"), key).alias("signed"),
        key.alias("plain"), F.concat(F.lit("0."), key, F.lit("1")).alias("fraction"),
    )
    typed = typing.apply_types(raw, typing.infer_types(raw, 1.0))
    # The scale of the decimal is that of the longest fraction.
    return typed.withColumn("fraction", F.regexp_replace(F.col("fraction").cast("string"), "0+$", ""))


@query(
    "infer_mixed_exponents",
    """
    SELECT event_id, CASE WHEN event_id % 1000 = 7 THEN '1000.00' ELSE (event_id + 12345678901234567) || '.25' END AS exact,
           CASE WHEN event_id % 1000 = 7 THEN '1e40' ELSE (event_id + 12345678901234567) || '.25' END AS too_wide,
           CASE WHEN event_id % 1000 = 7 THEN '0.00' ELSE event_id || '.50' END AS small
    FROM events
    """,
)
def infer_mixed_exponents(spark, sf):
    """A few exponents beside exact decimals: a decimal wide enough for both, or text where there is none."""
    key, rare = F.col("event_id").cast("string"), F.col("event_id") % 1000 == 7
    long = F.concat((F.col("event_id") + 12345678901234567).cast("string"), F.lit(".25"))
    raw = table(spark, sf, "events").select(
        "event_id", F.when(rare, "1e3").otherwise(long).alias("exact"), F.when(rare, "1e40").otherwise(long).alias("too_wide"),
        F.when(rare, "0e0").otherwise(F.concat(key, F.lit(".50"))).alias("small"),
    )
    typed = typing.apply_types(raw, typing.infer_types(raw, 1.0))
    return typed.select("event_id", *[F.col(c).cast("string").alias(c) for c in ("exact", "too_wide", "small")])


@query(
    "infer_mostly_flags",
    """
    SELECT event_id, CASE WHEN event_id % 20 = 3 THEN 7 ELSE 1 END::INTEGER AS quantity, event_id % 2 = 0 AS flag,
           CASE WHEN event_id % 20 = 3 THEN 'maybe' ELSE 'yes' END AS answer
    FROM events
    """,
)
def infer_mostly_flags(spark, sf):
    """Flags only if every value is one: a few other numbers make a number, a few other words leave text."""
    rare = F.col("event_id") % 20 == 3
    raw = table(spark, sf, "events").select(
        "event_id", F.when(rare, "7").otherwise("1").alias("quantity"), (F.col("event_id") % 2 == 0).cast("int").cast("string").alias("flag"),
        F.when(rare, "maybe").otherwise("yes").alias("answer"),
    )
    at_ninety = typing.infer_types(raw.select("quantity"))
    if at_ninety != {"quantity": "int"}:
        raise ValueError(f"quantities became {at_ninety}")
    return typing.apply_types(raw, typing.infer_types(raw, 1.0))


@query(
    "infer_document_types",
    r"""
    WITH p AS (
      SELECT 'text' AS "column", count(text) AS filled,
        avg(CAST(TRY_CAST(trim(text) AS DOUBLE) IS NOT NULL AS INTEGER)) AS number_share FROM documents
      UNION ALL SELECT 'lang', count(lang), avg(CAST(TRY_CAST(trim(lang) AS DOUBLE) IS NOT NULL AS INTEGER))
      FROM documents
      UNION ALL SELECT 'source', count(source), avg(CAST(TRY_CAST(trim(source) AS DOUBLE) IS NOT NULL AS INTEGER))
      FROM documents)
    SELECT "column", filled, number_share, 'string' AS type FROM p
    """,
)
def infer_document_types(spark, sf):
    profile = typing.inference_profile(table(spark, sf, "documents"))
    return profile.select(
        "column", "filled", F.col("number").alias("number_share"), typing.decided_type().alias("type")
    )


@query(
    "epoch_local_time",
    """
    WITH e AS (SELECT event_id, epoch_us(ts) // 1000000 AS s, ts FROM events)
    SELECT event_id, s AS epoch,
           strftime((TIMESTAMP '1970-01-01' + to_seconds(s)) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time,
           CAST(strftime((TIMESTAMP '1970-01-01' + to_seconds(s)) - INTERVAL 5 HOUR, '%Y%m%d') AS INTEGER) AS local_day,
           strftime((TIMESTAMP '1970-01-01' + to_seconds(s)) - INTERVAL 5 HOUR, '%H:%M') AS local_clock,
           CAST((s // 60) - (1704067199 // 60) AS BIGINT) AS minutes,
           CAST(((s // 60) - (1704067199 // 60)) // 60 AS VARCHAR) || '.' ||
             lpad(CAST(((s // 60) - (1704067199 // 60)) % 60 AS VARCHAR), 2, '0') AS h_mm
    FROM e
    """,
)
def epoch_local_time(spark, sf):
    e = table(spark, sf, "events").select("event_id", clock.to_epoch(F.col("ts")).alias("epoch"))
    local = clock.epoch_to_local(F.col("epoch"))
    millis = clock.epoch_to_utc(F.col("epoch") * 1000, "auto")
    minutes = clock.minute_boundaries(clock.epoch_to_utc(F.lit(1704067199)), millis)
    return e.select(
        "event_id",
        "epoch",
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        clock.day_key(local).alias("local_day"),
        clock.clock_label(local).alias("local_clock"),
        minutes.alias("minutes"),
        clock.hours_dot_minutes(minutes).alias("h_mm"),
    )


@query(
    "iso_to_utc",
    """
    SELECT event_id,
           strftime(CASE event_type WHEN 'view' THEN date_trunc('second', ts) + INTERVAL 5 HOUR
                                    WHEN 'click' THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
                                    ELSE date_trunc('second', ts) END, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS utc
    FROM events
    """,
)
def iso_to_utc(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    raw = (
        F.when(kind == "view", F.concat(stamp, F.lit("-05:00")))
        .when(kind == "click", F.concat(stamp, F.lit("+05:30")))
        .when(kind == "error", F.concat(stamp, F.lit("Z")))
        .otherwise(stamp)
    )
    rows = table(spark, sf, "events").select("event_id", raw.alias("utc"))
    return clean.normalize(rows, {"utc": {"type": "timestamp_to_utc"}})


@query(
    "scalar_functions",
    """
    SELECT o_orderkey, substring(o_orderpriority, 1, 4) AS sub, left(o_orderpriority, 2) AS l, right(o_orderpriority, 3) AS r,
           lpad(CAST(o_orderkey AS VARCHAR), 4, '0') AS padded,
           right('000000000000000000' || CAST(o_orderkey AS VARCHAR), 18) AS material_key,
           o_orderstatus || o_orderpriority AS joined, lower(o_orderpriority) AS low,
           split_part(o_orderpriority, '-', 2) AS part, regexp_replace(o_orderpriority, '[0-9]', '', 'g') AS no_digits,
           md5(o_orderpriority) AS hash, concat_ws(' ', o_orderstatus, o_orderpriority) AS ws,
           coalesce(nullif(o_orderstatus, 'F'), 'done') AS status,
           CAST(floor(o_totalprice) AS BIGINT) AS whole, abs(o_totalprice - 200000) AS distance,
           o_custkey % 7 AS rest, o_totalprice / nullif(o_custkey % 3, 0) AS share,
           CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_key,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
           strftime(o_orderdate + INTERVAL 36 HOUR, '%Y-%m-%d %H:%M:%S') AS later,
           CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS age_days,
           CAST(week(o_orderdate) AS INTEGER) AS iso_week
    FROM orders
    """,
)
def scalar_functions(spark, sf):
    p, d = F.col("o_orderpriority"), F.col("o_orderdate")
    later = F.timestamp_add("HOUR", F.lit(36), d)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring(p, 1, 4).alias("sub"),
        F.left(p, F.lit(2)).alias("l"),
        F.right(p, F.lit(3)).alias("r"),
        F.lpad(F.col("o_orderkey").cast("string"), 4, "0").alias("padded"),
        text.material_key(F.col("o_orderkey")).alias("material_key"),
        F.concat("o_orderstatus", p).alias("joined"),
        F.lower(p).alias("low"),
        F.split_part(p, F.lit("-"), F.lit(2)).alias("part"),
        F.regexp_replace(p, "[0-9]", "").alias("no_digits"),
        F.md5(p).alias("hash"),
        F.concat_ws(" ", "o_orderstatus", p).alias("ws"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("F")), F.lit("done")).alias("status"),
        F.floor("o_totalprice").alias("whole"),
        F.abs(F.col("o_totalprice") - 200000).alias("distance"),
        (F.col("o_custkey") % 7).alias("rest"),
        F.try_divide(F.col("o_totalprice"), (F.col("o_custkey") % 3).cast("double")).alias("share"),
        clock.month_key(d).alias("month_key"),
        F.date_format(F.trunc(d, "month"), "yyyy-MM-dd").alias("month_start"),
        F.date_format(later, "yyyy-MM-dd HH:mm:ss").alias("later"),
        F.datediff(F.lit("2002-01-01").cast("date"), d).alias("age_days"),
        F.weekofyear(d).alias("iso_week"),
    )


@query(
    "filter_predicates",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag
    FROM (SELECT *, nullif(l_returnflag, 'A') AS flag FROM lineitem)
    WHERE l_quantity BETWEEN 5 AND 45 AND l_linestatus IN ('O', 'F') AND l_discount <> 0.05
      AND (flag NOT IN ('N') OR l_shipdate >= TIMESTAMP '1998-01-01')
      AND NOT coalesce(flag LIKE '%R%' AND l_tax < 0.02, FALSE) AND NOT coalesce(flag = 'N' AND l_tax > 0.06, FALSE)
      AND regexp_matches(l_returnflag, '^[ANR]$')
    """,
)
def filter_predicates(spark, sf):
    flag = F.nullif(F.col("l_returnflag"), F.lit("A"))
    rows = table(spark, sf, "lineitem").filter(
        F.col("l_quantity").between(5, 45)
        & F.col("l_linestatus").isin("O", "F")
        & (F.col("l_discount") != 0.05)
        & (~flag.isin("N") | (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))
        & F.col("l_returnflag").rlike("^[ANR]$")
    )
    kept = sets.delete_where(rows, [flag.like("%R%") & (F.col("l_tax") < 0.02), (flag == "N") & (F.col("l_tax") > 0.06)])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query(
    "extract_types",
    """
    SELECT CAST(sum(CASE WHEN TRY_CAST(trim(CAST(user_id AS VARCHAR)) AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT)
             AS users_numeric,
           CAST(sum(TRY_CAST(CAST(user_id AS VARCHAR) AS DOUBLE)) AS DOUBLE) AS users_sum,
           count(nullif(event_type, 'view')) AS notes,
           strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS newest,
           CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS active
    FROM events
    """,
)
def extract_types(spark, sf):
    raw = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user"),
        F.when(F.col("event_type") == "view", "nan").otherwise(F.col("event_type")).alias("note"),
        clock.to_epoch(F.col("ts")).alias("date_created"),
        (F.col("value") > 20).cast("int").alias("is_active"),
    )
    typed = typing.apply_extract_types(raw, typing.extract_profile_types(raw))
    return typed.agg(
        F.count("user").alias("users_numeric"),
        F.sum("user").alias("users_sum"),
        F.count("note").alias("notes"),
        F.date_format(F.max("date_created"), "yyyy-MM-dd HH:mm:ss").alias("newest"),
        F.count_if("is_active").alias("active"),
    )


@query(
    "exact_money",
    """
    SELECT l_returnflag, CAST(sum(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0 AS gross
    FROM lineitem GROUP BY l_returnflag
    """,
)
def exact_money(spark, sf):
    from tributary.functions.money import exact_sum, major

    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(major(exact_sum(minor(F.col("l_extendedprice")))).alias("gross"))
    )
