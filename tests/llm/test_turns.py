"""Conversation repair against a search over all edits."""
import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from prepwise.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")


def search(rows):
    """``(cost, audit)`` of ``(initial, forced, truncated)`` rows, over every string of edits."""
    @lru_cache(None)
    def rest(i, out):
        found = [(0, "")] if i == len(rows) and GRAMMAR.fullmatch(out) else []
        for cost, letter, to, symbol in moves(i):
            if len(out + symbol) <= len(rows) + 3 and re.fullmatch("s?(ua)*u?", out + symbol):
                c, audit = rest(to, out + symbol)
                found.append((cost + c, letter + audit))
        return min(found, default=(10 ** 9, ""))

    def moves(i):
        yield from ((3, "I", i, "u"), (3, "I", i, "a"))
        if i < len(rows):
            initial, forced, short = rows[i]
            yield 4, "D", i + 1, ""
            if not forced:
                if initial in "sua" and initial:
                    yield 3 * short, "K", i + 1, initial
                yield from ((3 + 3 * short, "R", i + 1, s) for s in "ua")
    return rest(0, "")


def code(initial, forced, short):
    return {"s": 1, "u": 2, "a": 3}.get(initial, 0) + (turns._BLANK if forced else turns._SHORT if short else 0)


def test_every_short_conversation():
    r = random.Random(5)
    for trial in range(1500):
        rows = [(r.choice("suuaaax"), r.random() < 0.15, r.random() < 0.25) for _ in range(r.randint(0, 7))]
        rows = [(i, f, s and not f) for i, f, s in rows]
        codes = bytes(code(*x) for x in rows)
        want = search(tuple(rows))
        assert turns.repair(codes) == want, rows
        assert turns.fold(codes) == want, rows
        assert turns.incumbent(codes) >= want[0]


def test_long_conversations_band_and_fold():
    r = random.Random(6)
    for n, errors in ((400, 0.02), (300, 0.3), (250, 1.0)):
        codes = bytes(r.choice(range(32)) if r.random() < errors else 2 + i % 2 for i in range(n))
        codes = bytes(c if not c & turns._FORCED else c & ~turns._SHORT for c in codes)
        assert turns.repair(codes, 1 << 40) == turns.repair(codes, 0) == turns.fold(codes)
    cost, audit = turns.repair(bytes([2]) * 200_000)
    assert cost == 300_000 and len(audit) >= 200_000


def brute(rows):
    """Rows of the query from ``(conv_id, turn, role, text)``."""
    sp = lambda x: " " if x is None else x                                          # noqa: E731
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        rule = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if rule == 0:
            continue
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        kept += [(turn, "user" if rule == 4 else role, text)] * (2 if rule == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in kept:
            tail = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
            faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail not in ".!?" else "")
            seen.add((role, text))
        cost, audit = search(tuple((role[:1], f in ("blank", "duplicate"), f == "truncated") for (_, role, _), f in zip(kept, faults)))
        lines, at, last = [], 0, ""
        for step in audit:
            if step == "D":
                at += 1
                continue
            last = kept[at][1][0] if step == "K" else "a" if last == "u" else "u"
            role = kept[at][1] if step == "K" else {"u": "user", "a": "assistant"}[last]
            lines.append(role + ":" + ("" if step == "I" else kept[at][2]))
            at += step != "I"
        ts = [t for t, _, _ in kept if t is not None]
        initials = [role[:1] for _, role, _ in kept]
        out.append((conv, max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in turns.repaired(turns.damaged(df)).collect()), key=repr)


def test_conversations(spark):
    r = random.Random(7)
    rows = []
    for conv in [*range(250), None]:
        for turn in range(r.randint(1, 6)):
            rows.append((conv, r.choice([turn, turn, turn, turn + 3, None]), r.choice(["system", "user", "assistant", "assistant", "tool", None, "user"]),
                         r.choice(["Yes.", "No!", "a  \n", " \t", None, "Why? ", "é…", "line\nline."])))
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = brute(rows)
    assert result(df.withColumns({c: F.lit("clash") for c in ("kind", "audit", "cost", "code", "gone", "nth", "rule")})) == want
    assert any(w[6] > 10 for w in want)


def test_edges(spark):
    """Nulls everywhere, long texts, empty roles, only dropped turns, empty tables, a conversation of many turns."""
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(None, None, None, None), (dropped, 0, "user", "gone."), (5000, 1, "", "x."), (5001, 1, "user", "y" * 300_000 + "."), (5002, 1, "User", "z."), (5002, 1, "User", "z.")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(df)
    assert got == brute(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert result(df.limit(0)) == []
    many = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(20_000)]
    row = turns.repaired(turns.untouched(spark.createDataFrame(many, SCHEMA).repartition(6))).first()
    assert row["cost"] == 0 and row["audit"] == "K" * 20_000
    assert row["repaired_sha256"] == hashlib.sha256("\n".join(f"{c}:{t}" for _, _, c, t in many).encode()).hexdigest()


@pytest.mark.parametrize("n", [2, 7])
def test_same_rows_under_other_partitions(spark, n):
    rows = [(i % 3, i // 3, "user" if i % 2 else "assistant", f"text {i % 5}.") for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert [r[:7] for r in result(df.repartition(n))] == [r[:7] for r in result(df)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
