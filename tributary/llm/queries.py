"""One query per operator, on whole tables with the parameters meant for production."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.llm import archive, bpe, hashing, language, licenses, lines, mixing, near, quality, search, secrets, substrings, turns
from tributary.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op3_source_mixing")
def op3(spark, sf_dir):
    """Taken words per document; the cube method is not SQL (tests hold it to its targets)."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_quality_rules")
def op7(spark, sf_dir):
    """Counts and verdict; expectation-maximisation is not SQL."""
    return quality.scored(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


@query("op10_byte_bpe")
def op10(spark, sf_dir):
    """Token counts and digests; byte-pair merging is not SQL."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), VOCABULARY)


@query("op9_minhash_forest")
def op9(spark, sf_dir):
    """Components of near duplicates; reachability is not practical SQL on whole tables (tests use brute force)."""
    got = near.near_groups(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op2_line_dedup")
def op2(spark, sf_dir):
    """Lines removed per document; a similarity join over all lines is too slow in SQL (tests use brute force)."""
    return lines.line_counts(table(spark, sf_dir, "documents"))


@query("op1_multi_index_hashing")
def op1(spark, sf_dir):
    """Five nearest of every fiftieth vector; approximate, so recall is measured in tests."""
    return hashing.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


@query("op5_zstd_secrets")
def op5(spark, sf_dir):
    """Secrets of whole texts; compressed sizes are not SQL."""
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


@query("op6_crf_language")
def op6(spark, sf_dir):
    """Language of every text; a trained model is not SQL (tests measure held-out accuracy)."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


@query("op8_license_rules")
def op8(spark, sf_dir):
    """Base phrases and license labels; the rules' labels are not SQL (tests compare the base columns)."""
    return licenses.license_labels(table(spark, sf_dir, "documents"))


@query("op4_suffix_dedup")
def op4(spark, sf_dir):
    """Repeated 200-byte strings removed; SQL would need every string as a row (tests use brute force)."""
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


@query(
    "op11_pair_maxscore",
    r"""
    WITH said AS (
        SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents WHERE text IS NOT NULL
    ), sized AS (SELECT doc_id, r, len(terms) AS n, terms FROM said WHERE len(terms) > 0),
    corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sized),
    tf AS (SELECT doc_id, r, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, r, n, unnest(terms) AS term FROM sized) GROUP BY ALL),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), weight AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM tf, corpus GROUP BY term, docs
    ), scored AS (
        SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
        FROM asked JOIN tf USING (term) JOIN weight USING (term), corpus GROUP BY item_id, doc_id, r
    )
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0
    QUALIFY rank <= 10
    """,
)
def op11(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return search.rank(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op12_seekable_warc",
    """
    WITH paid AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    firsts AS (SELECT payload_digest, min(page_id) AS first FROM paid WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM paid LEFT JOIN firsts USING (payload_digest)
    """,
)
def op12(spark, sf_dir):
    """Every page's record as read back from the archives."""
    return archive.archived(spark, table(spark, sf_dir, "pages"))


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(state: str, cost: str, letter: str, line: str | None) -> str:
    """A struct of cost, audit and text after one more edit."""
    text = f"{state}.t" if line is None else f"CASE WHEN {state}.t IS NULL THEN {line} ELSE {state}.t || chr(10) || {line} END"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}}"


def _kept(state: str, letter: str, when: str, cost: str, line: str) -> str:
    never = "{'c': 1000000000, 'a': '~', 't': ''}"
    return f"CASE WHEN {when} THEN {_way(state, cost, letter, line)} ELSE {never} END"


def _repair_sql() -> str:
    """Forward search over the four states, one row at a time, with costs, audits and texts in full."""
    crc = (
        "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT), lambda h, b: "
        "list_reduce([xor(h, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
    )
    ok, extra = "NOT must", "cut"
    u, a, own = "'user:'", "'assistant:'", "role || ':' || txt"

    def say(state, cls, new):
        return [
            _kept(state, "K", f"{ok} AND cls = '{cls}'", extra, own),
            _kept(state, "R", ok, f"2 + {extra}", f"'{new}:' || txt"),
        ]

    rows = [
        _way("x0", "3", "D", None),
        _least(_way("x1", "3", "D", None), _kept("x0", "K", f"{ok} AND cls = 's'", extra, own)),
        _least(_way("x2", "3", "D", None), *say("x0", "u", "user"), *say("x1", "u", "user"), *say("x3", "u", "user")),
        _least(_way("x3", "3", "D", None), *say("x2", "a", "assistant")),
    ]
    ins = [_way(f"y{q}", "2", "I", u) for q in (0, 1, 3)]
    never = "{'c': 1000000000, 'a': '~', 't': ''}"
    return f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
    ), kinds AS (SELECT *, {crc} % 20 AS kind FROM keyed),
    hurt AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(txt, '[.!?]', '', 'g') ELSE txt END AS txt,
            unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM kinds WHERE kind <> 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || txt), copy) AS i FROM hurt
    ), seen AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY i) > 1 AS again,
            trim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
            lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS prior
        FROM placed
    ), faulty AS (
        SELECT conv_id, turn, i, role, txt, role[1:1] AS cls, bare = '' AS blank, bare <> '' AND again AS dup,
            NOT again AND bare <> '' AND bare[-1:] NOT IN ('.', '!', '?') AS trunc,
            prior IS NOT NULL AND prior || role[1:1] NOT IN ('su', 'ua', 'au') AS bad
        FROM seen
    ), r AS (SELECT *, blank OR dup AS must, trunc::INTEGER AS cut FROM faulty),
    dp AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': NULL::VARCHAR}} AS y0, {never} AS y1, {never} AS y2, {never} AS y3 FROM r
        UNION ALL
        SELECT conv_id, i, {rows[0]}, {rows[1]}, {rows[2]}, {rows[3]}
        FROM (
            SELECT r.conv_id, r.i, role, txt, cls, must, cut, y0 AS x0, y1 AS x1, {_least("y2", *ins)} AS x2,
                {_least("y3", _way(_least("y2", *ins), "2", "I", a))} AS x3
            FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1
        )
    ), ends AS (
        SELECT conv_id, {_least("y0", "y3", _way(_least("y2", *ins), "2", "I", a))} AS best
        FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
    ), counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
            count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated, count(*) FILTER (bad) AS illegal
        FROM r GROUP BY conv_id
    )
    SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
        coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
        coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
    """


@query("op13_conversation_repair", _repair_sql())
def op13(spark, sf_dir):
    """Damaged conversations, repaired at the least cost."""
    whole = table(spark, sf_dir, "conversations")
    return turns.repair(whole, turns.damage(whole))
