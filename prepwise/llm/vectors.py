"""Near-duplicate vectors: a small-world graph per shard, every shard asked, links verified.

Equal vectors are one node with a multiplicity.  Nodes are dealt to ``SHARDS`` graphs by
a hash; tasks build the graphs into the shared folder.  Every node then asks every graph with a
beam; beams that come back full of links are widened, and after each block a recall audit
compares some of its queries with a plain scan of the shard: while it finds less than
``RECALL`` of the links, the block is asked again with a beam twice as wide (at the width of the
shard that is a full scan, so the loop ends).  Candidates are verified by cosine in double
precision.  A task passes on link counts and a spanning forest of the links it saw, never all
pairs; the components of the forests are the components of the links.  A vector's link count
is of the links that its own search found and verified; the recall audit bounds what it misses.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing (component: their own id); vectors of different lengths never link; a null id
stays null and names no component unless all ids of the component are null; repeated rows
are vectors of their own that link with each other; an empty table gives an empty result."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hnsw
from .common import Scratch, components, get_array, put_array

THRESHOLD = 0.9
SHARDS = 8
BEAM = 64
RECALL = 0.98
AUDIT = 16
_BLOCK = 1024
_SEEN = 1 << 25


def usable(vec: Column) -> Column:
    """Whether a vector can link at all."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def _unit(rows) -> np.ndarray:
    v = np.array([np.asarray(r, np.float64) for r in rows])
    v = v / np.abs(v).max(1, keepdims=True)               # no overflow, no underflow
    return v / np.sqrt((v * v).sum(1, keepdims=True))


class Shard:
    """A stored graph as one task sees it."""

    def __init__(self, folder: str, name: str, layers: int):
        get = lambda part: get_array(f"{folder}/{name}-{part}.npy")
        self.vectors, self.nodes, self.times = get("vectors"), get("nodes"), get("times")
        self.near = np.asarray(self.vectors, np.float32)
        self.layers = [get(f"layer{i}") for i in range(layers)]

    def links(self, queries: np.ndarray, threshold: float, beam: int, recall: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``(query, place)`` with cosine of at least ``threshold``."""
        n = len(self.nodes)
        while True:
            found = self._ask(queries, threshold, min(beam, n))
            if beam >= n or self._recall(queries, threshold, *found) >= recall:
                return found
            beam *= 2

    def _scan(self, queries, threshold):
        hit = np.argwhere(queries @ self.vectors.T >= threshold)
        return hit[:, 0], hit[:, 1]

    def _ask(self, queries, threshold, beam):
        n, rows, places = len(self.nodes), [], []
        todo = np.arange(len(queries))
        short = queries.astype(np.float32)
        entries = hnsw.descend(self.near, self.layers, short, 0)
        while len(todo):
            if beam >= n:
                q, p = self._scan(queries[todo], threshold)
                rows.append(todo[q])
                places.append(p)
                break
            nodes, sims = hnsw.beam_search(self.near, self.layers[0], short[todo], entries[todo], beam)
            close = sims >= threshold - 1e-3
            full = close.sum(1) * 2 > beam                # the beam may have been too narrow: widen it
            q, at = np.nonzero(close & ~full[:, None])
            p = nodes[q, at]
            exact = np.einsum("nd,nd->n", queries[todo[q]], self.vectors[p]) >= threshold
            rows.append(todo[q[exact]])
            places.append(p[exact])
            todo, beam = todo[full], beam * 2
        return np.concatenate(rows), np.concatenate(places)

    def _recall(self, queries, threshold, rows, places) -> float:
        """Share of the links of audited queries that were found: some with links, some without."""
        count = np.bincount(rows, minlength=len(queries))
        pick = np.concatenate([x[np.linspace(0, len(x) - 1, min(AUDIT, len(x))).astype(int)] for x in (np.flatnonzero(count), np.flatnonzero(count == 0)) if len(x)])
        q, _ = self._scan(queries[pick], threshold)
        return count[pick].sum() / len(q) if len(q) else 1.0


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star per component of the edges ``(a, b)``: each node with the smallest one."""
    names, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = where[: len(a)], where[len(a):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, x, low)
        np.minimum.at(after, y, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    other = label != np.arange(len(names))
    return names[other], names[label[other]]


def near_vectors(table: DataFrame, threshold: float = THRESHOLD, shards: int = SHARDS, beam: int = BEAM, recall: float = RECALL,
                 id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``table``."""
    scratch = Scratch(table.sparkSession, "vectors")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    good = rows.where(usable(F.col("vec")))
    nodes = scratch.save(good.groupBy("vec").agg(F.count("*").alias("times"), F.min("vec_id").alias("first")).withColumn(
        "node", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")))
    folder = scratch.folder("graphs")

    def store(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order")
        name, unit = f"{pdf['dim'].iloc[0]}-{pdf['shard'].iloc[0]}", _unit(pdf["vec"])
        layers = hnsw.build(unit)
        for part, array in [("vectors", unit), ("nodes", pdf["node"].to_numpy(np.int64)), ("times", pdf["times"].to_numpy(np.int64)),
                            *((f"layer{i}", x) for i, x in enumerate(layers))]:
            put_array(f"{folder}/{name}-{part}.npy", array)
        return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "name": [name], "layers": [len(layers)]})

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(shards))).withColumn("order", F.xxhash64(F.lit(1), "vec"))
    # a stated number of partitions: a graph is long work on few bytes, which sizes alone would pack together
    dealt = dealt.repartition(4 * shards, "dim", "shard")
    stored = dealt.groupBy("dim", "shard").applyInPandas(store, "dim int, name string, layers int").collect()     # a row per graph
    graphs: dict[int, list] = {}
    for r in sorted(stored):
        graphs.setdefault(r["dim"], []).append((r["name"], r["layers"]))

    def ask(batches):
        held: dict[str, Shard] = {}
        for b in batches:
            for dim, group in b.groupby("dim"):
                for at in range(0, len(group), _BLOCK):
                    yield from block(held, int(dim), group.iloc[at:at + _BLOCK])

    def block(held, dim, part):
        unit, own = _unit(part["vec"]), part["node"].to_numpy(np.int64)
        links = part["times"].to_numpy(np.int64) - 1
        ends: list[tuple] = []
        for name, layers in graphs[dim]:
            if name not in held:
                held.clear()                              # one graph at a time
                held[name] = Shard(folder, name, layers)
            shard = held[name]
            step = max(1, _SEEN // len(shard.nodes))
            for at in range(0, len(own), step):
                q, p = shard.links(unit[at:at + step], threshold, beam, recall)
                q = q + at
                other = shard.nodes[p] != own[q]
                q, p = q[other], p[other]
                links = links + np.bincount(q, shard.times[p], len(own)).astype(np.int64)
                if len(q):
                    ends.append(_forest(own[q], np.asarray(shard.nodes[p])))
        yield pd.DataFrame({"a": own, "b": own, "links": links})
        if ends:
            a, b = _forest(np.concatenate([x for x, _ in ends]), np.concatenate([y for _, y in ends]))
            yield pd.DataFrame({"a": a, "b": b, "links": 0})

    tasks = max(1, -(-nodes.count() // (2 * _BLOCK)))
    asked = scratch.save(nodes.select("node", "dim", "times", "vec").repartition(tasks, F.xxhash64("node")).mapInPandas(ask, "a long, b long, links long"))
    edges = asked.where("a <> b").select("a", "b")
    joined = components(scratch, edges)
    counts = asked.where("a = b").select(F.col("a").alias("node"), "links")
    named = nodes.join(joined, "node", "left").withColumn("root", F.coalesce("component", "node")).drop("component")
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = named.join(names, "root").join(counts, "node").select("vec", F.col("links").alias("n_links"), "component_id")
    out = rows.withColumn("key", F.when(usable(F.col("vec")), F.col("vec"))).drop("vec").join(facts.withColumnRenamed("vec", "key"), "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
