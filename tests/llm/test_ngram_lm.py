import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from prepwise.llm import ngram_lm

from .brute import words

SCHEMA = "doc_id long, text string"


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts, order, cut):
        toks = [[*words(t), None] for t in texts]
        self.order, self.uni = order, Counter(w for t in toks for w in t)
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.grams = {}
        for k in range(2, order + 1):
            c = Counter(tuple(t[i:i + k]) for t in toks for i in range(len(t) - k + 1))
            for g, x in c.items():
                if x >= cut:
                    self.grams.setdefault(g[:-1], {})[g[-1]] = x

    def p(self, ctx, w):
        if not ctx:
            return (self.uni[w] + 1) / (self.n + self.v + 1)
        low, kids = self.p(ctx[1:], w), self.grams.get(ctx)
        if not kids:
            return low
        return (kids.get(w, 0) + len(kids) * low) / (sum(kids.values()) + len(kids))

    def score(self, text):
        t = [*words(text), None]
        base = sum(math.log10(self.p((), w)) for w in t)
        return len(t), sum(self.uni[w] > 0 for w in t), base, sum(math.log10(self.p(tuple(t[max(0, i - self.order + 1):i]), w)) for i, w in enumerate(t))


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "The", "é漢", "x" * 300]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 90)))) for i in range(150)]
    return rows + [(1000, None), (1001, ""), (1002, " \t\n"), (5, "the the the the"), (1003, "never seen words"), (None, "w1 w2"), (1004, "w1 w2 w3 " * 5000)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_model_matches_dictionaries(spark, order):
    rows = corpus()
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    plain = Plain([t for i, t in rows if not held(i)], order, ngram_lm.CUT)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("n", F.lit(1)).repartition(4)
    got = ngram_lm.score_documents(df, order=order).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), held(i), *plain.score(t)) for i, t in rows)
    have = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got)
    for a, b in zip(have, want):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=1e-6)
        assert a[5] == pytest.approx(b[5], abs=2e-4 * a[2])    # 16-bit probabilities
    assert {r["train_tokens"] for r in got} == {plain.n}


def test_probabilities_of_a_context_sum_to_one(spark):
    rows = [(1, "a b c a b d a b c"), (3, "a b c b a"), (4, "c c a b")]
    state = ngram_lm.fit(spark.createDataFrame(rows, SCHEMA))
    model = ngram_lm.Model(*state)
    total = 0.0
    for w in ("a", "b", "c", "d", "unseen"):
        with_w = ngram_lm.score_texts(model, [f"a b {w}"])[3] - ngram_lm.score_texts(model, ["a b"])[3]
        end = [ngram_lm._chain(model, *_ids(model, t), 3) for t in (f"a b {w}", "a b")]
        total += 10 ** float(with_w[0] - _last(model, f"a b {w}") + _last(model, "a b"))
        assert len(end[0]) == 2
    assert total + 10 ** _last(model, "a b") == pytest.approx(1, abs=0.01)


def _ids(model, text):
    hashes, ends = ngram_lm.tokens([text])
    return ngram_lm._ids(model, hashes)[0], ends


def _last(model, text):
    """log10 probability of the end after ``text``."""
    hashes, ends = ngram_lm.tokens([text])
    ids, counts = ngram_lm._ids(model, hashes)
    best = np.log10(model.unigram(counts))
    for child, prob, back in ngram_lm._chain(model, ids, ends, 3):
        best = np.where(child >= 0, prob, back + best)
    return float(best[-1])


def test_words_seen_once_after_a_context_count(spark):
    rows = [(1, " ".join(f"of v{i}" for i in range(998)) + " of the of the")]
    plain = Plain([rows[0][1]], 3, 1)
    model = ngram_lm.Model(*ngram_lm.fit(spark.createDataFrame(rows, SCHEMA)))
    for text in ("of the", "of v7", "x of the", "v3 of v4"):
        got = ngram_lm.score_texts(model, [text])
        assert float(got[3][0]) == pytest.approx(plain.score(text)[3], abs=2e-3)
    with_the, of = (float(ngram_lm.score_texts(model, [t])[3][0]) - _last(model, t) for t in ("of the", "of"))
    assert 10 ** (with_the - of) < 0.01                        # 2 of 1000, not 2 of 3


def test_empty_tables(spark):
    assert ngram_lm.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = ngram_lm.score_documents(spark.createDataFrame([(held, "a b")], SCHEMA)).collect()[0]
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


def test_better_than_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = ngram_lm.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


@pytest.mark.parametrize("shard_bytes", [300, 1 << 30])
def test_shards_grow_with_the_text(spark, shard_bytes):
    rows = corpus()
    plain = Plain([t for _, t in rows], 3, 1)
    state = ngram_lm.fit(spark.createDataFrame(rows, SCHEMA).repartition(3), shard_bytes=shard_bytes)
    model = ngram_lm.Model(*state)
    size = sum(len((t or "").encode()) for _, t in rows)
    assert model.shards == 1 + size // shard_bytes
    # ranges of longer contexts are even, whatever their first word
    assert np.diff(model.starts(2)).max() <= 1 + model.nodes[0][-1] // model.shards
    got = ngram_lm.score_texts(model, [t for _, t in rows])
    for (_, text), *have in zip(rows, *got):
        want = plain.score(text)
        assert (have[0], have[1]) == want[:2] and have[2] == pytest.approx(want[2], abs=1e-6)
        assert have[3] == pytest.approx(want[3], abs=2e-4 * have[0])


def test_counter_gives_out_sums_by_range():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 50, 400).astype(np.uint64) << np.uint64(40)
    low = (keys >> np.uint64(38)).astype(np.uint16)
    cuts = np.array([7 << 40, 7 << 40, 30 << 40], np.uint64)
    for part in (None, low):
        counter = ngram_lm.Counter(cuts)
        assert list(counter.add(keys[:150], None if part is None else part[:150])) == []
        list(counter.add(keys[150:], None if part is None else part[150:]))
        table = pa.Table.from_batches(counter.rest())
        found = {}
        for i in range(table.num_rows):
            s, k, n, x = ngram_lm.received(pa.concat_tables([table.slice(i, 1)] * 2))
            assert s == (0 if k[0] < 7 << 40 else 2 if k[0] < 30 << 40 else 3) and (np.diff(k.astype(np.int64)) > 0).all()
            assert x is None if part is None else (x == k >> np.uint64(38)).all()
            found |= dict(zip(k.tolist(), n.tolist()))
        assert found == {k: 2 * n for k, n in Counter(keys.tolist()).items()}
