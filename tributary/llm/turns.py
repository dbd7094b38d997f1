"""Repair of damaged conversations at the least cost: run-length dynamic programming over roles and faults.

A conversation is a sequence of symbols, one a row: the class of its role (system, user, assistant, other) with its
first fault. Each symbol is a min-plus transition between four states (nothing said, after s, after u, after a).
Equal consecutive symbols form a run; a run of n rows advances the costs through the binary powers of its
transition, which are cached per symbol. The costs to go at the run ends then steer an unrolling of the choices from
the first row, least letter first, which gives the audit and the repaired turns.

On Spark: rows are sorted by range over (conversation, turn, digest), so that a conversation with a third of all
rows is spread over many partitions, and numbered; symbols are joined to strings per block of ``BLOCK`` rows and then
per conversation, one character a row, which is no more than the audit that the result holds anyway. Choices go
back to the rows by row number, a unique key. Texts never meet in one group.

Defined cases: a null role or text counts as one space; rows of one turn are ordered by the digest of role and text,
so repeated rows stand side by side and all but one are duplicates; a null turn sorts first and takes no part in
gaps; null conversation ids form one conversation; a role counts by its first character, case-sensitive; a role of
no character or another one is illegal beside any neighbour and can only be reroled or deleted; an empty table has
no conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stage

#: Rows whose symbols are joined to one string before the strings of a conversation are.
BLOCK = 256
#: Rows of a run unrolled with their costs kept; longer runs are cut by binary powers.
LEAF = 64

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 40
#: State after a role is said, by state: 0 nothing, 1 system, 2 user, 3 assistant.
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
ACCEPTED = (0, 3)
CLASSES = "suao"
FAULTS = ("", "blank", "duplicate", "truncated")
#: One letter for each pair of class and fault, class first.
SYMBOLS = "ABCDEFGHIJKLMNOP"

Costs = tuple[int, int, int, int]


def wanted(state: int) -> str:
    """The role that may be inserted or reroled to in a state."""
    return "a" if state == 2 else "u"


def meaning(symbol: str) -> tuple[str, str]:
    place = SYMBOLS.index(symbol)
    return CLASSES[place // 4], FAULTS[place % 4]


def row_edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Edits of one row without insertions: letter, cost, next state; least letter first."""
    cls, fault = meaning(symbol)
    out = [("D", DELETE, state)]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        if state in AFTER[cls]:
            out.append(("K", extra, AFTER[cls][state]))
        out.append(("R", REROLE + extra, AFTER[wanted(state)][state]))
    return out


def with_insertions(costs: list[int]) -> Costs:
    """Costs to go when turns may be inserted first; the second pass settles chains of two."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[AFTER[wanted(q)][q]]) for q, c in enumerate(costs)]
    return tuple(costs)


#: Costs after the last row.
END: Costs = with_insertions([0 if q in ACCEPTED else NEVER for q in range(4)])


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> tuple[Costs, ...]:
    """The min-plus transition of 2^k rows of one symbol; 16 symbols and the bits of a length bound the cache."""
    if k:
        half = power(symbol, k - 1)
        return tuple(tuple(min(row[m] + half[m][q] for m in range(4)) for q in range(4)) for row in half)
    columns = []
    for end in range(4):
        bare = [min([c for _, c, to in row_edits(symbol, q) if to == end], default=NEVER) for q in range(4)]
        columns.append(with_insertions(bare))
    return tuple(zip(*columns))


def through(matrix: tuple[Costs, ...], after: Costs) -> Costs:
    return tuple(min(a + b for a, b in zip(row, after)) for row in matrix)


def before_run(symbol: str, length: int, after: Costs) -> Costs:
    """Costs to go before a run, by the binary powers of its length."""
    k = 0
    while length:
        if length & 1:
            after = through(power(symbol, k), after)
        length >>= 1
        k += 1
    return after


def unroll_run(symbol: str, length: int, after: Costs, state: int, marks: list[str], audit: list[str]) -> int:
    """Append the choices for a run entered in ``state``; returns the state behind it."""
    if length > LEAF:
        k = (length - 1).bit_length() - 1
        state = unroll_run(symbol, length - (1 << k), through(power(symbol, k), after), state, marks, audit)
        return unroll_run(symbol, 1 << k, after, state, marks, audit)
    to_go = [after]
    for _ in range(length):
        to_go.append(through(power(symbol, 0), to_go[-1]))
    for left in range(length, 0, -1):
        here, then, said = to_go[left], to_go[left - 1], ""
        while True:
            edits = row_edits(symbol, state)
            letter, _, nxt = next((e for e in edits if e[1] + then[e[2]] == here[state]), ("R", 0, state))
            turn = AFTER[wanted(state)][state]
            if letter != "D" and INSERT + here[turn] == here[state]:
                said += wanted(state).upper()
                audit.append("I")
                state = turn
                continue
            said += {"D": "", "K": "k", "R": wanted(state)}[letter]
            audit.append(letter)
            state = nxt
            break
        marks.append(said)
    return state


def solve(symbols: str) -> tuple[int, str, list[str]]:
    """Least cost, ASCII-least audit of that cost, and what each row becomes.

    A row's mark lists what is said in its place: ``U`` and ``A`` inserted turns, ``k`` the row, ``u`` and ``a`` the
    row under another role. Insertions after the last row are in its mark.
    """
    runs = [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]
    ends = [END]
    for symbol, length in reversed(runs):
        ends.append(before_run(symbol, length, ends[-1]))
    cost = ends.pop()[0]
    state, marks, audit = 0, [], []
    for symbol, length in runs:
        state = unroll_run(symbol, length, ends.pop(), state, marks, audit)
    while state not in ACCEPTED:
        marks[-1] += wanted(state).upper()
        audit.append("I")
        state = AFTER[wanted(state)][state]
    return cost, "".join(audit), marks


solve_short = lru_cache(maxsize=1 << 14)(solve)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of their place: dropped, emptied, cut off, repeated or said by the user."""
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("kind"),
    )
    return rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def numbered(rows: DataFrame) -> DataFrame:
    """Rows in order with a number ``pos``, staged; a conversation's rows have consecutive numbers or leap with a partition."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    named = rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("content"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("content")]
    ranged = named.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.withColumn("pos", F.monotonically_increasing_id()), "turns")


def _symbol(cls: Column, fault: Column) -> Column:
    return F.substring(F.lit(SYMBOLS), cls * 4 + fault + 1, F.lit(1))


def symbols(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``pos``, ``turn`` and the symbol of each numbered row."""
    firsts = rows.groupBy("conv_id", "content").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    ended = F.rtrim(F.translate("text", "\t\n\x0b\f\r", "     "))
    initial = F.substring("role", 1, 1)
    cls = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    light = rows.select(
        "conv_id", "turn", "pos", cls.alias("cls"), (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    return light.join(firsts, "pos", "left").select("conv_id", "turn", "pos", _symbol(F.col("cls"), fault).alias("symbol"))


def _joined(pairs: str, value: str) -> Column:
    return F.concat_ws("", F.transform(F.array_sort(pairs), lambda p: p[value]))


def choices(rows: DataFrame) -> DataFrame:
    """Per conversation: counts of faults, illegal neighbours, cost, audit, and per block the marks of its rows."""
    marked = symbols(rows)
    blocks = (
        marked.groupBy("conv_id", F.shiftright("pos", BLOCK.bit_length() - 1).alias("block"))
        .agg(F.min("pos").alias("start"), F.collect_list(F.struct("pos", "symbol")).alias("pairs"))
        .select("conv_id", F.struct("start", _joined("pairs", "symbol").alias("symbols")).alias("part"))
    )
    whole = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    span = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    ).select(F.col("conv_id").alias("_id"), "gaps")
    schema = (
        "conv_id {}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "marks array<struct<start:long,marks:string>>"
    ).format(rows.schema["conv_id"].dataType.simpleString())
    return whole.mapInArrow(_solve_batches, schema).join(span, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")


def _solve_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for parts in batch.column("parts").to_pylist():
            line = "".join(p["symbols"] for p in parts)
            cost, audit, marks = (solve_short if len(line) <= LEAF else solve)(line)
            roles = [meaning(s)[0] for s in line]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
            count = {f: sum(n for s, n in ((s, line.count(s)) for s in set(line)) if meaning(s)[1] == f) for f in FAULTS[1:]}
            at, pieces = 0, []
            for p in parts:
                pieces.append({"start": p["start"], "marks": ",".join(marks[at : at + len(p["symbols"])])})
                at += len(p["symbols"])
            out.append((count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, pieces))
        names = ("blank", "duplicate", "truncated", "illegal", "cost", "audit", "marks")
        types = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("marks", pa.string())]))]
        columns = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], ["conv_id", *names])


def repaired_turns(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, place (``pos``, ``part``), ``role``, ``text`` of every turn left."""
    pieces = chosen.select(F.explode("marks").alias("piece"))
    marks = pieces.select("piece.start", F.posexplode(F.split("piece.marks", ","))).select(
        (F.col("start") + F.col("pos")).alias("pos"), F.col("col").alias("mark")
    )
    said = rows.join(marks.filter("mark <> ''"), "pos").select("*", F.posexplode(F.split("mark", "")).alias("part", "is"))
    role = F.when(F.lower("is") == "u", "user").when(F.lower("is") == "a", "assistant").otherwise(F.col("role"))
    text = F.when(F.col("is").isin("U", "A"), "").otherwise(F.col("text"))
    return said.select("conv_id", "pos", "part", role.alias("role"), text.alias("text"))


def _digest_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest a conversation from sorted rows; holds one hash state, never a conversation."""
    state, current = None, None
    for batch in batches:
        out = []
        for name, line in zip(batch["name"], batch["line"]):
            if state is not None and name == current:
                state.update(b"\n")
            else:
                if state is not None:
                    out.append((current, state.hexdigest()))
                state, current = hashlib.sha256(), name
            state.update(line.encode())
        yield pd.DataFrame(out, columns=["name", "repaired_sha256"])
    if state is not None:
        yield pd.DataFrame([(current, state.hexdigest())], columns=["name", "repaired_sha256"])


def _name(conv_id: str) -> Column:
    """A conversation's id as text; the null id is the only one without the sign."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def turn_digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines. The hash has no mergeable state, so a conversation's lines
    pass through one task, sorted on disk and read as a stream."""
    lines = turns.select(_name("conv_id").alias("name"), "pos", "part", F.concat("role", F.lit(":"), "text").alias("line"))
    ordered = lines.repartition("name").sortWithinPartitions("name", "pos", "part").select("name", "line")
    return ordered.mapInPandas(_digest_batches, "name string, repaired_sha256 string")


def repair(conversations: DataFrame, hurt: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``, repaired as far as ``hurt`` still holds it."""
    rows = numbered(hurt)
    chosen = stage(choices(rows), "turns-chosen")
    digests = turn_digests(repaired_turns(rows, chosen))
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    found = ids.join(chosen.drop("marks"), F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    found = found.join(digests, _name("_id") == F.col("name"), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
