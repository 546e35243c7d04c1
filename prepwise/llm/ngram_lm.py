"""N-gram language model in a trie of Elias-Fano levels, built and queried by Spark tasks.

Counts come from every training document.  Words are numbered in the order of their
64-bit hashes; the vocabulary and each level are cut into ranges of context nodes, one group
of a builder task each and as many as hold ``SHARD_BYTES`` of training text on average.  Counting
tasks send each range their sorted n-grams in few rows, as gaps and counts; the group adds them up.
A level stores, per context node, the successors as one rising sequence
(a context's successors are written relative to the end of the context before, so a
successor search is one Elias-Fano lookup), monotone pointers from context to successors,
and log10 probabilities quantised to 16 bits.  Files, one for each range, lie in the shared folder and are
memory-mapped by the scoring tasks; nothing that grows with the corpus is broadcast.

Probabilities interpolate with Witten-Bell weights: ``P(w | c) = (n(c, w) + T P(w | c')) / (n(c) + T)``
over all successors of the training text, ``T`` the number of them, and at the bottom the add-one
unigram.  ``cut`` above 1 drops n-grams seen less often, and with them their part of ``n(c)`` and ``T``;
a longer n-gram can only reach it if the two shorter ones inside do, so each counting pass asks the
levels already built first.

Defined results: null text counts as empty (one token, the end); a null id has remainder 0;
without training tokens base and score are 0 per token of a model that knows
nothing (``log10 1``); repeated rows count and are scored each; an empty table gives an
empty result.  Two words with equal 64-bit hashes would count as one."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, get_array, give_back, put_array, residue
from .elias_fano import EliasFano
from .words import distinct_of, hashed_words, mix, runs_of

ORDER = 3
CUT = 1
SHARD_BYTES = 12_000_000                                   # of training text to a range of contexts
FOLDS, HELD = 7, 2
_END = mix(np.array([0], np.uint64))[0]
_CHUNK = 4_000_000
_HOLD = 4_000_000                                          # tokens counted before their n-grams are sent
_PARTS = "shard int, keys binary, n binary, low binary"
_FLOOR = -14.0
_STEP = -_FLOOR / 65535


def tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, ends)``: word hashes with one end token after each text, and where the ends stand."""
    h, counts = hashed_words(texts)
    ends = np.cumsum(counts + 1) - 1
    out = np.empty(len(h) + len(counts), np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word], out[ends] = h, _END
    return out, ends


def pack(array: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones: high bytes of small numbers compress away."""
    return array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes()


def unpack(data, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def summed(keys: np.ndarray, n: np.ndarray | None, low: np.ndarray | None) -> tuple:
    """Sorted distinct ``keys``, their sums of ``n`` (None: ones) and their ``low``, the same for equal keys."""
    if n is None and low is None:
        keys, order = np.sort(keys), None
    else:
        order = np.argsort(keys)
        keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    times = np.diff(first, append=len(keys)) if n is None else np.add.reduceat(n[order], first, dtype=np.int64) if len(keys) else np.empty(0, np.int64)
    return keys[first], times, None if low is None else low[order[first]]


class Counter:
    """Adds up counts of 64-bit keys and gives them out by ranges, whenever it holds too many.

    ``cuts`` are the first keys of all ranges but the first.  ``low`` of ``add`` goes along with its key."""

    def __init__(self, cuts: np.ndarray):
        self.cuts, self.parts, self.held = cuts, [], 0

    def add(self, keys: np.ndarray, low: np.ndarray | None = None):
        self.parts.append((keys, low))
        self.held += len(keys)
        if self.held >= _HOLD:
            yield from self.rest()

    def rest(self):
        if not self.held:
            return
        low = None if self.parts[0][1] is None else np.concatenate([x for _, x in self.parts])
        keys, n, low = summed(np.concatenate([k for k, _ in self.parts]), None, low)
        self.parts, self.held = [], 0
        edges = np.concatenate(([0], np.searchsorted(keys, self.cuts), [len(keys)]))
        rows = [(s, slice(edges[s], edges[s + 1])) for s in np.flatnonzero(np.diff(edges)).tolist()]
        yield pa.RecordBatch.from_arrays([
            pa.array([s for s, _ in rows], pa.int32()),
            pa.array([pack(np.diff(keys[x], prepend=np.uint64(0))) for _, x in rows], pa.binary()),
            pa.array([pack(n[x].astype(np.uint32)) for _, x in rows], pa.binary()),
            pa.array([None if low is None else pack(low[x]) for _, x in rows], pa.binary())], names=["shard", "keys", "n", "low"])


def received(group: pa.Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray | None]:
    """A range and its ``(keys, n, low)`` from the rows of all counting tasks."""
    shard = group.column("shard")[0].as_py()
    rows = lambda name, kind: [unpack(x.as_buffer(), kind) for x in group.column(name)]
    keys = np.concatenate([np.cumsum(gaps, dtype=np.uint64) for gaps in rows("keys", np.uint64)])
    low = None if group.column("low").null_count else np.concatenate(rows("low", np.uint16))
    return shard, *summed(keys, np.concatenate(rows("n", np.uint32)), low)


def texts_of(batches, column: str = "text"):
    """``(batch, from, texts)``: the texts of Arrow batches, about ``_CHUNK`` bytes at a time."""
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        for i, j in runs_of(lengths, _CHUNK):
            yield b, i, b.column(column).slice(i, j - i).to_pylist()
    give_back()


class Model:
    """The stored trie as one task sees it; arrays are mapped when first asked for."""

    def __init__(self, folder: str, sizes: list[int], total: int, levels: list[list[int]]):
        self.folder, self.total, self.shards = folder, total, len(sizes)
        self.offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.size = int(self.offsets[-1])
        self.bits = np.uint64(self.size.bit_length())          # of a word's id, and of the next one for unknown words
        self.nodes = [np.concatenate(([0], np.cumsum(x))).astype(np.int64) for x in levels]    # per level, first node of each shard
        self.held = {}

    def array(self, name: str, part: str) -> np.ndarray:
        key = f"{name}-{part}"
        if key not in self.held:
            self.held |= {f"{name}-{k}": x for k, x in unjoined(get_array(f"{self.folder}/{name}.npy")).items()}
        return self.held[key]

    def sequence(self, name: str, kind: str) -> EliasFano:
        key = f"{name}-{kind}#"
        if key not in self.held:
            self.held[key] = EliasFano.of(lambda part: self.array(name, f"{kind}-{part}"))
        return self.held[key]

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes, -1 for words without training count."""
        out = np.full(len(hashes), -1, np.int64)
        cuts = np.concatenate(([0], np.searchsorted(hashes, hash_cuts(self.shards)), [len(hashes)]))
        for s in np.flatnonzero(np.diff(cuts) > 0):
            if self.offsets[s + 1] == self.offsets[s]:
                continue
            own, ask = self.array(f"words-{s}", "hashes"), hashes[cuts[s]:cuts[s + 1]]
            at = np.minimum(np.searchsorted(own, ask), len(own) - 1)
            out[cuts[s]:cuts[s + 1]] = np.where(own[at] == ask, at + self.offsets[s], -1)
        return out

    def by_shard(self, starts: np.ndarray, nodes: np.ndarray):
        """``(shard, positions)`` of sorted node numbers."""
        cuts = np.searchsorted(nodes, starts)
        for s in np.flatnonzero(np.diff(cuts) > 0).tolist():
            yield s, slice(int(cuts[s]), int(cuts[s + 1]))

    def keys(self, nodes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """One number for a context node and a word's id, in the order of both."""
        return (nodes.astype(np.uint64) << self.bits) | words.astype(np.uint64)

    def parts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (keys >> self.bits).astype(np.int64), (keys & ((np.uint64(1) << self.bits) - np.uint64(1))).astype(np.int64)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of sorted word ids."""
        out = np.zeros(len(ids), np.int64)
        for s, part in self.by_shard(self.offsets, ids):
            out[part] = self.array(f"words-{s}", "counts")[ids[part] - self.offsets[s]]
        return out

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Add-one probabilities of words with these training counts."""
        return (counts + 1.0) / (self.total + self.size + 1.0)

    def starts(self, level: int) -> np.ndarray:
        """First context node of each range of ``level``: ranges of words as dealt, of longer contexts even ones."""
        return self.offsets if level == 1 else np.arange(self.shards + 1) * int(self.nodes[level - 2][-1]) // self.shards

    def children(self, level: int, nodes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Successor search on ``level`` (1: successors of words): for context nodes and word ids, sorted by
        both, the child nodes (-1 where there is none), their log10 probability and the context's log10 weight
        of the lower order."""
        child, prob, back = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes)), np.zeros(len(nodes))
        starts, own = self.starts(level), self.nodes[level - 1]
        for s, part in self.by_shard(starts, nodes):
            if own[s + 1] == own[s]:
                continue
            name = f"level{level}-{s}"
            node = nodes[part]
            new = np.concatenate(([True], node[1:] != node[:-1]))
            ctx, where = node[new] - starts[s], np.cumsum(new) - 1
            pointer, next_ = self.sequence(name, "pointers"), self.sequence(name, "next")
            first = pointer.access(ctx).astype(np.int64)
            last = pointer.access(ctx + 1).astype(np.int64)
            base = np.zeros(len(ctx), np.uint64)
            base[first > 0] = next_.access(first[first > 0] - 1)
            back[part] = (self.array(name, "back")[ctx] * -_STEP)[where]
            have = np.flatnonzero((last > first)[where] & (words[part] < self.size))
            at = next_.find(base[where[have]] + words[part][have].astype(np.uint64) + np.uint64(1))
            good = (at >= first[where[have]]) & (at < last[where[have]])
            have, at = have[good] + part.start, at[good]
            child[have] = at + own[s]
            prob[have] = self.array(name, "prob")[at] * -_STEP
        return child, prob, back


def hash_cuts(shards: int) -> np.ndarray:
    """The first hash of all even ranges but the first."""
    return np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)


def _sorted_children(model: Model, level: int, nodes: np.ndarray, words: np.ndarray):
    """``children`` for keys in any order, each distinct key asked once."""
    keys = model.keys(nodes, words)
    order = np.argsort(keys)
    keys = keys[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.empty(0, bool)
    where = np.empty(len(keys), np.int64)
    where[order] = np.cumsum(new) - 1
    found = model.children(level, *model.parts(keys[new]))
    return tuple(x[where] for x in found)


def _ids(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ids and training counts of tokens."""
    distinct, where = distinct_of(hashes)
    ids = model.word_ids(distinct)
    counts = np.zeros(len(ids), np.int64)
    counts[ids >= 0] = model.counts(ids[ids >= 0])             # ids rise with the hashes
    return ids[where], counts[where]


def _chain(model: Model, ids: np.ndarray, ends: np.ndarray, depth: int):
    """Nodes of the ``depth``-grams that end at each token: level by level ``(node, prob, back, has)`` where the
    context node exists; an n-gram never crosses a text's end."""
    begin = np.zeros(len(ids), np.int64)                       # tokens before this one in its text
    first = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else np.empty(0, np.int64)
    begin = np.arange(len(ids)) - np.repeat(first, np.diff(np.concatenate((first, [len(ids)]))))
    node, out = ids, []                                        # node of the gram that ends here
    for level in range(1, depth):
        ok = np.zeros(len(ids), bool)
        ok[1:] = (node[:-1] >= 0) & (begin[1:] >= level)
        at = np.flatnonzero(ok)
        child, prob, back = np.full(len(ids), -1, np.int64), np.zeros(len(ids)), np.zeros(len(ids))
        ask = np.where(ids[at] >= 0, ids[at], model.size)      # an unknown word has no node anywhere
        c, p, b = _sorted_children(model, level, node[at - 1], ask)
        child[at], prob[at], back[at] = c, p, b
        out.append((child, prob, back))
        node = child
    return out


def score_texts(model: Model, texts, order: int = ORDER) -> tuple[np.ndarray, ...]:
    """``(n_tokens, n_known, base, score)`` per text."""
    hashes, ends = tokens(texts)
    first = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    n = ends - first + 1
    if not model.size:
        zero = np.zeros(len(n))
        return n, zero.astype(np.int64), zero, zero
    ids, counts = _ids(model, hashes)
    base = np.log10(model.unigram(counts))
    best = base.copy()
    for child, prob, back in _chain(model, ids, ends, order):
        best = np.where(child >= 0, prob, back + best)         # no context: back is 0, the lower order holds
    add = lambda x: np.add.reduceat(x, first) if len(first) else np.empty(0)
    return n, add((counts > 0).astype(np.int64)), add(base), add(best)


def _quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.round(np.maximum(log10, _FLOOR) / -_STEP), 0, 65535).astype(np.uint16)


def joined(arrays: dict[str, np.ndarray]) -> np.ndarray:
    """Arrays as one of bytes, to be stored and mapped as one file."""
    names = "\n".join(f"{k} {x.dtype.str} {len(x)}" for k, x in arrays.items()).encode()
    bytes_ = [np.array([len(names)], np.int64).view(np.uint8), np.frombuffer(names, np.uint8), *(np.ascontiguousarray(x).view(np.uint8) for x in arrays.values())]
    return np.concatenate([y for x in bytes_ for y in (x, np.zeros(-len(x) % 8, np.uint8))])


def unjoined(data: np.ndarray) -> dict[str, np.ndarray]:
    size = int(data[:8].view(np.int64)[0])
    at, out = 8 + size + -size % 8, {}
    for line in bytes(data[8:8 + size]).decode().split("\n"):
        name, kind, n = line.split(" ")
        length = int(n) * np.dtype(kind).itemsize
        out[name] = data[at:at + length].view(kind)
        at += length + -length % 8
    return out


def _by_sorted(f, values: np.ndarray) -> np.ndarray:
    distinct, where = distinct_of(values)
    return f(distinct)[where]


def build_level(model: Model, level: int, shard: int, keys: np.ndarray, counts: np.ndarray, low: np.ndarray | None) -> None:
    """Write one shard of a level from its n-grams, sorted ``Model.keys``, and their counts.

    ``low``: quantised probabilities of their words in the context one word shorter (level 1: None)."""
    nodes, words = model.parts(keys)
    starts = model.starts(level)
    ctx = nodes - starts[shard]
    n_ctx = int(starts[shard + 1] - starts[shard])
    total = np.bincount(ctx, counts, n_ctx)
    kinds = np.bincount(ctx, minlength=n_ctx)
    weight = np.where(kinds > 0, kinds / np.maximum(total + kinds, 1), 1.0)
    p = model.unigram(_by_sorted(model.counts, words)) if low is None else 10.0 ** (low * -_STEP)
    p = (counts + kinds[ctx] * p) / (total + kinds)[ctx]
    prob = _quantised(np.log10(p))
    del nodes, p
    pointers = np.concatenate(([0], np.cumsum(kinds)))
    # successors relative to where the context before ended, so that the whole sequence rises
    own_last = np.zeros(n_ctx, np.int64)
    own_last[ctx] = words + 1                                  # keys are sorted: the last one of a context stays
    base = np.concatenate(([0], np.cumsum(own_last)[:-1])) if n_ctx else own_last
    sequences = {"pointers": EliasFano.encode(pointers), "next": EliasFano.encode(base[ctx] + words + 1)}
    parts = {f"{kind}-{k}": x for kind, seq in sequences.items() for k, x in seq.arrays().items()}
    put_array(f"{model.folder}/level{level}-{shard}.npy", joined(parts | {"prob": prob, "back": _quantised(np.log10(weight))}))


def fit(docs: DataFrame, text_col: str = "text", order: int = ORDER, cut: int = CUT, shard_bytes: int = SHARD_BYTES) -> tuple:
    """Count and store the model of ``docs``; returns the arguments of ``Model``."""
    scratch = Scratch(docs.sparkSession, "ngrams")
    folder = scratch.folder("trie")
    source = docs.select(F.col(text_col).alias("text"))
    shards = 1 + (source.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes

    def words(batches):
        counter = Counter(hash_cuts(shards))
        for _, _, texts in texts_of(batches):
            yield from counter.add(tokens(texts)[0])
        yield from counter.rest()

    def store(group: pa.Table) -> pa.Table:
        s, hashes, n, _ = received(group)
        put_array(f"{folder}/words-{s}.npy", joined({"hashes": hashes, "counts": n}))
        return pa.table({"shard": pa.array([s], pa.int32()), "size": [len(hashes)], "total": [int(n.sum())]})

    def grouped(run, build, schema):
        rows = source.mapInArrow(run, _PARTS).groupBy("shard").applyInArrow(build, schema).collect()    # a row per shard
        scratch.release()
        return rows

    written = grouped(words, store, "shard int, size long, total long")
    sizes, total = [0] * shards, sum(r["total"] for r in written)
    for r in written:
        sizes[r["shard"]] = r["size"]
    levels: list[list[int]] = []
    for level in range(1, order):
        state = (folder, list(sizes), total, [list(x) for x in levels])
        here = [0] * shards
        for r in grouped(_counting(state, level, cut), _building(state, level, cut), "shard int, size long"):
            here[r["shard"]] = r["size"]
        levels.append(here)
    return folder, sizes, total, levels


def _counting(state: tuple, level: int, cut: int):
    def run(batches):
        model = Model(*state)
        starts = model.starts(level)[1:-1]
        counter = Counter(model.keys(starts, np.zeros(len(starts), np.int64)))
        for _, _, texts in texts_of(batches):
            hashes, ends = tokens(texts)
            ids, counts = _ids(model, hashes)
            grams = _chain(model, ids, ends, level)
            node = grams[-1][0] if grams else np.where(counts >= cut, ids, -1)
            first = np.zeros(len(ids), bool)
            first[0] = True
            first[ends[:-1] + 1] = True
            ok = np.zeros(len(ids), bool)
            ok[1:] = (node[:-1] >= 0) & (node[1:] >= 0) & ~first[1:]     # both shorter n-grams were kept
            at = np.flatnonzero(ok)
            # what the shorter n-gram's level holds for the word is the lower order's probability
            low = np.round(grams[-1][1][at] / -_STEP).astype(np.uint16) if grams else None
            yield from counter.add(model.keys(node[at - 1], ids[at]), low)
        yield from counter.rest()

    return run


def _building(state: tuple, level: int, cut: int):
    def run(group: pa.Table) -> pa.Table:
        s, keys, n, low = received(group)
        keep = n >= cut
        keys, n, low = keys[keep], n[keep], None if low is None else low[keep]
        if len(keys):
            build_level(Model(*state), level, s, keys, n, low)
        give_back()
        return pa.table({"shard": pa.array([s], pa.int32()), "size": [len(keys)]})

    return run


def score_documents(docs: DataFrame, folds: int = FOLDS, held: int = HELD, order: int = ORDER, cut: int = CUT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``,
    by a model of the rows that are not held out."""
    fold = residue(F.col(id_col), folds) == held
    state = fit(docs.where(~fold), text_col, order, cut)

    def run(batches):
        model = Model(*state)
        for b, i, texts in texts_of(batches):
            n, known, base, score = score_texts(model, texts, order)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, len(n)), b.column("held_out").slice(i, len(n)), pa.array(n, pa.int64()),
                                              pa.array(known, pa.int64()), pa.array(np.full(len(n), model.total)), pa.array(base), pa.array(score)],
                                             names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), fold.alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
