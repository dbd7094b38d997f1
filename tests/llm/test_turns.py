"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from tributary.llm import turns

GOOD = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """Uniform-cost search over (row, roles so far); rows are (initial, must_delete, cut). Least cost, then least audit."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, tail = heapq.heappop(heap)
        # What is said so far matters only by its last role and by whether it is all of it.
        if (i, tail) in done:
            continue
        if i == len(rows) and tail in ("", "a"):
            return cost, audit
        if i < len(rows):
            initial, must, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, tail))
            if not must:
                if initial and (initial == "s" and tail == "" or tail + initial in ("u", "su", "ua", "au")):
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, initial))
                heapq.heappush(heap, (cost + cut + 2, audit + "R", i + 1, "a" if tail == "u" else "u"))
        heapq.heappush(heap, (cost + 2, audit + "I", i, "a" if tail == "u" else "u"))
        done.add((i, tail))


def plain(rows, damaged=False):
    """Result rows for (conv_id, turn, role, text), damaged first unless they already are."""
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        if damaged:
            kind = 9
        else:
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            kept[conv] = kept[conv]
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, mine in kept.items():
        def place(r):
            content = hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()
            return (r[0] is not None, r[0] or 0, content)
        mine = sorted(mine, key=place)
        numbers = [t for t, _, _ in mine if t is not None]
        seen, faults = set(), []
        for _, role, text in mine:
            bare = text.strip(" \t\n\x0b\f\r")
            faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = cheapest([(r[1][:1], f in ("b", "d"), f == "t") for r, f in zip(mine, faults)])
        lines, i, tail = [], 0, ""
        for letter in audit:
            new = "assistant" if tail == "u" else "user"
            if letter == "I":
                lines.append(new + ":")
                tail = new[0]
                continue
            if letter == "K":
                lines.append(f"{mine[i][1]}:{mine[i][2]}")
                tail = mine[i][1][0]
            if letter == "R":
                lines.append(f"{new}:{mine[i][2]}")
                tail = new[0]
            i += 1
        assert GOOD.fullmatch("".join(x[0] for x in lines))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out.append((conv, gaps, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert got(turns.repair(rows, turns.damage(rows))) == plain([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


@pytest.fixture(scope="module")
def odd_turns(spark):
    rows = [
        (1, 0, "user", "Hi.", 1), (1, 1, None, "Yes.", 1), (1, 1, "assistant", "Yes.", 1), (1, None, "system", "Be kind", 0), (2, 5, None, None, 0),
        (3, 0, "", "x.", 0), (3, 0, "", "x.", 0), (3, 9, "User", "y!", 0), (None, None, None, None, None), (None, 3, "user", "a?", 0),
        (None, 3, "user", "a?", 0), (4, 2, "assistant", "\x0b \t", 0), (5, -4, "umpire", "Out.\n", 0), (5, 4, "assistant", "long " * 50_000, 0),
        (6, 1, "system", "s.", 0), (6, 2, "system", "t.", 0), (7, 1, "system", "only.", 0),
    ] + [(8, i, "user", f"{i}.", 0) for i in range(300)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int").repartition(3).cache()


def test_odd_turns(spark, odd_turns):
    rows = [tuple(r)[:4] for r in odd_turns.collect()]
    assert got(turns.repair(odd_turns, turns.damage(odd_turns))) == plain(rows)
    assert got(turns.repair(odd_turns, odd_turns)) == plain(rows, damaged=True)
    nothing = odd_turns.limit(0)
    assert got(turns.repair(nothing, turns.damage(nothing))) == []
    gone = got(turns.repair(odd_turns, nothing))
    assert len(gone) == 9 and all(r[1:7] == (0,) * 6 and r[7:] == ("", hashlib.sha256(b"").hexdigest()) for r in gone)


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant", "tool"]), rng.choice(["", f"{i}.", f"{i}", "same."])) for i in range(3000)] + [(2, 0, "user", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert got(turns.repair(df, df)) == plain(rows, damaged=True)


@pytest.mark.parametrize("seed", range(60))
def test_runs_agree_with_the_search(seed):
    rng = random.Random(seed)
    line = "".join(rng.choice("ABCDEFGHIJKLMNOP"[: rng.choice([4, 9, 16])]) * rng.choice([1, 1, 2, 5, 70]) for _ in range(rng.randrange(8)))
    rows = [(turns.meaning(s)[0], turns.meaning(s)[1] in ("blank", "duplicate"), turns.meaning(s)[1] == "truncated") for s in line]
    cost, audit, marks = turns.solve(line)
    assert (cost, audit) == cheapest(rows) and len(marks) == len(line)


def test_long_runs_use_binary_powers():
    cost, audit, marks = turns.solve("E" * 100_001)
    # The user's turns get answers; one may do without by being deleted or reroled, which is never cheaper.
    assert cost == 2 * audit.count("I") + 2 * audit.count("R") + 3 * audit.count("D")
    assert cost == 100_001 + 1 and len(marks) == 100_001
    step = turns.END
    for _ in range(1000):
        step = turns.through(turns.power("E", 0), step)
    assert step == turns.before_run("E", 1000, turns.END)
