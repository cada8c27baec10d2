"""Conversation repair against a shortest-path search over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import conversation_repair as C
from strata.llm.queries import op11_conversation_repair

from .helpers import SF, frame

SCHEMA = "conv_id long, turn long, role string, text string"
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
FULL = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def brute(rows):
    """Counts, cost, audit and repaired lines of one conversation, cheapest first."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                       hashlib.sha256(r[2].encode()).hexdigest()))
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        shown = text.strip(C.WHITE)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                      else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au")
                  for a, b in zip(rows, rows[1:], strict=False))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, place, lines = heapq.heappop(heap)
        if (at, place) in done:
            continue
        done.add((at, place))
        if at == len(rows) and place in ("", "a"):
            break
        for x in "ua":
            if x in STEPS[place]:
                heapq.heappush(heap, (cost + 5, audit + "I", at, x, (*lines, FULL[x] + ":")))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, place, lines))
        if faults[at] in ("blank", "duplicate"):
            continue
        cost += 5 * (faults[at] == "truncated")
        if role[:1] in STEPS[place]:
            heapq.heappush(heap, (cost, audit + "K", at + 1, STEPS[place][role[:1]],
                                  (*lines, f"{role}:{text}")))
        for x in "ua":
            if x in STEPS[place]:
                heapq.heappush(heap, (cost + 1, audit + "R", at + 1, x,
                                      (*lines, f"{FULL[x]}:{text}")))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, list(lines)


def grouped(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


def reports(found):
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit)
            for r in found.report.collect()}


def lines(found):
    out = {}
    for r in found.rows().orderBy("conv", "at").collect():
        out.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    return out


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", "u", None]
    texts = ["Yes.", "No!", "so", "", " \t", "same.", "end. \n", "x ", "\U0001F600?", None]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts))
            for c in [None, *range(60)] for _ in range(rng.randrange(1, 9))]
    rows += [(100, t, "user", "again.") for t in range(40)] * 3  # one text, many copies
    rows += [(101, t, "ua"[t % 2] * 3, f"{t}." * 2000) for t in range(30)]
    return rows


def test_equals_shortest_path(spark, odd):
    found = C.repair(frame(spark, odd, SCHEMA), "conv_id", "turn", "role", "text")
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd]
    want = {c: brute(rows) for c, rows in grouped(clean).items()}
    assert reports(found) == {c: w[:-1] for c, w in want.items()}
    assert lines(found) == {c: w[-1] for c, w in want.items() if w[-1]}


def test_digests_and_damage(spark, odd):
    df = frame(spark, odd, SCHEMA)
    broken = C.damaged(df, "conv_id", "turn", "role", "text")
    found = C.repair(broken, "conv", "turn", "role", "text", F.col("copies"))
    left = grouped(damage(odd))
    got = {r.conv: r for r in found.digests().collect()}
    assert set(got) == {r[0] for r in odd}
    for conv, r in got.items():
        gaps, blank, duplicate, truncated, illegal, cost, audit, out = brute(left.get(conv, []))
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (
            gaps, blank, duplicate, truncated, illegal, cost, audit)
        assert r.repaired_sha256 == hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_conversation_over_many_tasks(spark):
    """One conversation holds most rows; its spans come from several tasks."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", "c", f"{t}."]))
            for t in range(3000)] + [(c, 0, "user", "hi.") for c in range(2, 40)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(6)
        found = C.repair(df, "conv_id", "turn", "role", "text")
        want = {c: brute(r)[:-1] for c, r in grouped(rows).items()}
        assert reports(found) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_splits_do_not_matter():
    """Combining spans in any order gives one cell."""
    rng = random.Random(3)
    for _ in range(40):
        cells = [C.row_cell(rng.choice(["s", "u", "a", "t", ""]), rng.randrange(3))
                 for _ in range(rng.randrange(1, 9))]
        whole = C.parse(list(cells))
        left = cells[0]
        for cell in cells[1:]:
            left = C.join_cells(left, cell)
        right = cells[-1]
        for cell in cells[-2::-1]:
            right = C.join_cells(cell, right)
        assert whole == left == right


def test_empty_table(spark):
    found = C.repair(spark.createDataFrame([], SCHEMA), "conv_id", "turn", "role", "text")
    assert found.digests().count() == found.rows().count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    left = grouped(damage(rows))
    got = {r.conv_id: (r.cost, r.audit) for r in op11_conversation_repair(spark, SF).collect()}
    assert got == {c: brute(left.get(c, []))[5:7] for c in {r[0] for r in rows}}
