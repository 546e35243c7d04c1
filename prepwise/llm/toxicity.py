"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams (``ORDERS`` code points, lower-cased, white space runs as
one blank, a blank at both ends), hashed to ``2**BITS`` slots.  The ratio of slot ``j`` is
``log((p_j + A) / |p|) - log((q_j + A) / |q|)`` with ``p`` and ``q`` the numbers of toxic and
other training documents that hold it; these counts cover every training document.  A logistic
regression on the ratios of a document's slots (L2, classes weighted alike) is fitted on
about ``FIT_ROWS`` training documents of each class, chosen by a hash of their id; that
bound is the only sample.  One task fits it; the driver gets the weights (``2**BITS`` at most).

Defined results: null text counts as empty (scored by the intercept); a null id counts as
held out; several labels of an id count as the largest, null labels as none; without
labels of both classes every score is the share of toxic labels (0 if there are none);
repeated rows are scored each; an empty table gives an empty result."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, residue

ORDERS = (3, 4, 5)
BITS = 18
ALPHA = 0.1
FIT_ROWS = 1000
L2 = 1.0
STEPS = 100
FOLDS = 5
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(128, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CHUNK = 1 << 20


def slots(text: str | None, orders: tuple = ORDERS, bits: int = BITS) -> np.ndarray:
    """Slot of every n-gram of a text, repeats included (a long text is hashed in pieces)."""
    codes = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    space = _SPACE[np.minimum(codes, 127)] & (codes < 128)
    keep = ~space
    keep[0] = True
    keep[1:] |= ~space[:-1]                           # the first blank of a run stays
    codes = np.where(space, 32, codes)[keep].astype(np.uint64)
    if len(codes) <= 2 and not (codes != 32).any():
        return np.empty(0, np.int64)
    out, top = [], max(orders)
    for at in range(0, len(codes), _CHUNK):
        piece = codes[at:at + _CHUNK + top - 1]
        h = np.zeros(len(piece), np.uint64)
        for n in range(1, top + 1):
            h = h[: len(piece) - n + 1] if n > 1 else h
            h = (h ^ piece[n - 1:]) * _MULT
            h ^= h >> np.uint64(29)
            if n in orders:
                grams = min(_CHUNK, len(h))
                out.append(((h[:grams] * _MULT) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Distinct:
    """Distinct slots of one text after another, over one reused flag array."""

    def __init__(self, bits: int = BITS):
        self.flags = np.zeros(1 << bits, bool)

    def of(self, index: np.ndarray) -> np.ndarray:
        self.flags[index] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found


def fit_linear(rows: list[np.ndarray], toxic: np.ndarray, ratio: np.ndarray, l2: float = L2, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights per slot (ratio included) and intercept; accelerated gradient descent."""
    used = np.unique(np.concatenate(rows)) if rows else np.empty(0, np.int64)
    place = np.zeros(len(ratio), np.int64)
    place[used] = np.arange(len(used))
    lens = np.array([len(r) for r in rows])
    cols = place[np.concatenate(rows)] if rows else np.empty(0, np.int64)
    vals = ratio[used][cols]
    owner = np.repeat(np.arange(len(rows)), lens)
    y = toxic.astype(float)
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    lipschitz = 0.25 * (weight * np.bincount(owner, vals * vals, len(rows))).sum() + 0.25
    penalty = l2 / len(rows)
    w, b = np.zeros(len(used)), 0.0
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        z = np.bincount(owner, vals * vw[cols], len(rows)) + vb
        g = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        step = 1 / (lipschitz + penalty)
        nw = vw - step * (np.bincount(cols, vals * g[owner], len(used)) + penalty * vw)
        nb = vb - step * g.sum()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    full = np.zeros(len(ratio))
    full[used] = w * ratio[used]
    return full, float(b)


def train(scratch: Scratch, docs: DataFrame, labels: DataFrame, folds: int | None = FOLDS, orders: tuple = ORDERS, bits: int = BITS,
          fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, float]:
    """Weights and intercept learned from the labelled rows outside fold 0 (all rows if ``folds`` is None)."""
    marked = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(F.col(label_col).cast("int")).alias("toxic"))
    if folds:
        marked = marked.where(residue(F.col("doc_id"), folds) != 0)
    # one plan at every size: neither side has a bound that would allow a broadcast
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(marked.hint("merge"), "doc_id")
    per = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}    # two rows
    share = {c: min(1.0, fit_rows / max(1, per.get(c, 0))) for c in (0, 1)}
    cut = F.when(F.col("toxic") > 0, share[1]).otherwise(share[0])
    drawn = (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1_000_000)) / 1_000_000 < cut).alias("fit")

    def gather(batches):
        counts, distinct = np.zeros((2, 1 << bits), np.int64), Distinct(bits)
        totals = [0, 0]
        for b in batches:
            feats, ys = [], []
            for text, y, fit in zip(b["text"], b["toxic"], b["fit"]):
                found = distinct.of(slots(text, orders, bits))
                counts[int(y > 0), found] += 1
                totals[int(y > 0)] += 1
                if fit:
                    feats.append(found)
                    ys.append(int(y > 0))
            if feats:
                yield pd.DataFrame({"slot": -1, "pos": ys, "neg": 0, "feats": feats})
        held = np.flatnonzero(counts.any(0))
        yield pd.DataFrame({"slot": held, "pos": counts[1, held], "neg": counts[0, held], "feats": None})
        yield pd.DataFrame({"slot": [-2], "pos": totals[1], "neg": totals[0], "feats": None})

    gathered = scratch.save(known.select("text", "toxic", drawn).mapInPandas(gather, "slot long, pos long, neg long, feats array<long>"))
    counted = gathered.where("slot <> -1").groupBy("slot").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.lit(None).cast("array<long>").alias("feats"))
    sample = gathered.where("slot = -1")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        stats = pdf[pdf["slot"] >= 0]
        at = stats["slot"].to_numpy(np.int64)
        p, q = np.full(1 << bits, ALPHA), np.full(1 << bits, ALPHA)
        p[at] += stats["pos"].to_numpy(float)
        q[at] += stats["neg"].to_numpy(float)
        ratio = np.zeros(1 << bits)
        ratio[at] = (np.log(p / p.sum()) - np.log(q / q.sum()))[at]
        total = pdf[pdf["slot"] == -2]
        pos, neg = (int(total[c].sum()) for c in ("pos", "neg"))
        rows = pdf[pdf["slot"] == -1]
        if not pos or not neg or rows["pos"].nunique() < 2:
            share = pos / (pos + neg) if pos + neg else 0.0
            return pd.DataFrame({"slot": [-1], "weight": [np.log(max(share, 1e-9) / max(1 - share, 1e-9))]})
        feats = [np.asarray(x, np.int64) for x in rows["feats"]]
        w, b = fit_linear(feats, rows["pos"].to_numpy(), ratio)
        own = np.flatnonzero(w)
        return pd.DataFrame({"slot": np.concatenate((own, [-1])), "weight": np.concatenate((w[own], [b]))})

    # bounded by parameters: 2**bits counts and 2 * fit_rows documents
    one = counted.unionByName(sample).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "slot long, weight double")
    learned = one.toPandas()
    w = np.zeros(1 << bits, np.float32)
    inner = learned[learned["slot"] >= 0]
    w[inner["slot"].to_numpy(np.int64)] = inner["weight"].to_numpy(np.float32)
    base = learned.loc[learned["slot"] == -1, "weight"]
    return w, float(base.iloc[0]) if len(base) else -30.0


def score_column(spark, model: tuple[np.ndarray, float], orders: tuple = ORDERS, bits: int = BITS):
    """A function of a text column: the probability that its label is 1."""
    shared = spark.sparkContext.broadcast(model)                      # 2**bits floats

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        w, b = shared.value
        distinct = Distinct(bits)
        z = np.array([float(w[distinct.of(slots(t, orders, bits))].sum(dtype=float)) + b for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``; fold 0 is never learned from."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    model = train(scratch, docs, labels, folds, id_col=id_col, text_col=text_col, **options)
    score = score_column(docs.sparkSession, model)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), (residue(F.col(id_col), folds) == 0).alias("held_out"), score(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns kept."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    score = score_column(docs.sparkSession, train(scratch, docs, labels, id_col=id_col, text_col=text_col, **options))
    name = free_name(docs.columns, "__score")
    return docs.withColumn(name, score(F.col(text_col))).where(F.col(name) < 0.5).drop(name)
