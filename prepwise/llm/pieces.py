"""SentencePiece encoding and decoding with exact N-best segmentations.

The model's pieces and scores span a lattice over the text (blanks written as U+2581, one put
in front).  A forward Viterbi pass gives the best score of every prefix; a backward A* search
from the end uses it as its heuristic, which is exact, so complete paths leave the queue in
the order of their scores.  No piece continues past the start of a blank run, so the lattice
falls apart into units (a blank run and what follows up to the next).  The forward pass runs over many
units at once and a backward one gives each unit's loss to its second best; the N best of a
text are combined exactly from those of its units, and only the few units whose loss can
matter for a text are searched.

A character that is no piece costs the lowest ordinary score less 10 and is written as its byte pieces.
Equal scores are ordered by the ids of the changed places.

Defined results: null and empty texts have no pieces, score 0 and one segmentation;
white space other than the blank is kept through byte pieces; texts of any length are
read whole; null ids and repeated rows stay as they are; a text that holds U+2581 itself
decodes to a blank there (``round_trip`` false); an empty table gives an empty result."""
from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 3
#: Pieces with scores this low are barred in effect; they do not set the cost of unknown characters.
BARRED = -1e8
MARK = "▁"
#: Units kept, characters encoded and units solved at a time; less needs less memory and more time.
_CACHE_UNITS, _CHUNK_CHARS, _SOLVE_UNITS = 400_000, 2_000_000, 8192
_LONG_UNIT = 24
SCHEMA = ("doc_id long, n_pieces int, score double, ids array<int>, nbest array<struct<score: double, n_pieces: int, "
          "changes: array<struct<at: int, gone: int, ids: array<int>>>>>, round_trip boolean")
_CHANGE = pa.struct([("at", pa.int32()), ("gone", pa.int32()), ("ids", pa.list_(pa.int32()))])
_NBEST = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int32()), ("changes", pa.list_(_CHANGE))]))


class Vocabulary:
    """Pieces of a SentencePiece model: plain data, a few thousand entries, sent to the tasks."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], special: set[int]):
        self.pieces = pieces
        usable = {p: i for i, p in enumerate(pieces) if i not in special and i not in set(byte_ids) and p}
        self.ids = {p: (i, scores[i]) for p, i in usable.items()}
        self.longest = max(map(len, usable), default=1)
        self.byte_ids = byte_ids
        self.unknown = min((scores[i] for i in usable.values() if scores[i] > BARRED), default=0.0) - 10
        self.raw = [b"" if i in special else p.encode() for i, p in enumerate(pieces)]
        for value, i in enumerate(byte_ids):
            self.raw[i] = bytes([value])

    @staticmethod
    def read(path: str = MODEL) -> tuple:
        """The constructor's arguments from a model file."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        by_name = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        return ([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)],
                [by_name[f"<0x{b:02X}>"] for b in range(256)], special)

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        return cls(*cls.read(path))

    def edges(self, unit: str, end: int) -> list[tuple[int, float, tuple]]:
        """Lattice edges ``(start, score, ids)`` that end at ``end``."""
        out = []
        for start in range(max(0, end - self.longest), end):
            hit = self.ids.get(unit[start:end])
            if hit is not None:
                out.append((start, hit[1], (hit[0],)))
        if unit[end - 1] not in self.ids:
            out.append((end - 1, self.unknown, tuple(self.byte_ids[b] for b in unit[end - 1].encode("utf-8", "surrogatepass"))))
        return out

    def nbest(self, unit: str, best: int = BEST) -> list[tuple[float, tuple]]:
        """The ``best`` best segmentations of a unit, ``(score, ids)``, best first."""
        into = [None] + [self.edges(unit, e) for e in range(1, len(unit) + 1)]
        top = [0.0] * (len(unit) + 1)
        for e in range(1, len(unit) + 1):
            top[e] = max(top[s] + score for s, score, _ in into[e])
        # backward A*: what is behind a position is known exactly, what is before it is top[position]
        queue, found, order = [(-top[-1], 0, len(unit), 0.0, None)], [], 0
        while queue and len(found) < best:
            _, _, at, behind, tail = heapq.heappop(queue)
            if at == 0:
                ids = []
                while tail is not None:
                    ids.extend(tail[0])
                    tail = tail[1]
                found.append((behind, tuple(ids)))
                continue
            for s, score, ids in into[at]:
                order += 1
                heapq.heappush(queue, (-(top[s] + score + behind), -order, s, score + behind, (ids, tail)))
        return found

    def decode(self, ids) -> str:
        raw = self.raw
        text = b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def combine(choices: list[tuple[int, list]], best: int) -> list[tuple[float, list]]:
    """The ``best`` cheapest ways to change a best path: ``choices`` are ``(place, alternatives)``
    with alternatives ``(loss, what)`` in order, the first of loss 0 (unchanged).

    Only the ``best - 1`` places of least first loss can matter: changing any other place
    alone is no better than the unchanged path and those ``best - 1`` single changes."""
    ways = [(0.0, [])]
    for place, alternatives in choices:
        ways = heapq.nsmallest(best, (
            (loss + more, [*changes, (place, n)] if n else changes)
            for loss, changes in ways for n, (more, _) in enumerate(alternatives)), key=lambda w: (w[0], w[1]))
    return ways


class Lattices:
    """Forward and backward Viterbi over many units at once, grouped by length.

    Pieces are looked up by hashes of code points and compared code by code."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.tables = vocabulary, {}
        by_length: dict[int, list] = {}
        for piece, (i, score) in vocabulary.ids.items():
            by_length.setdefault(len(piece), []).append((piece, i, score))
        for n, entries in by_length.items():
            codes = _codes([p for p, _, _ in entries], n)
            h = _hash(codes)
            order = np.argsort(h, kind="stable")
            self.tables[n] = (h[order], codes[order], np.array([i for _, i, _ in entries])[order], np.array([x for _, _, x in entries])[order])

    def solve(self, units: list[str]):
        """``(known, ids, counts, best, gap)`` of units of one length: ids and score of the best path, the
        loss of the second best (infinite if there is none); ``known`` is false where a character is no piece."""
        n, size = len(units), len(units[0])
        codes = _codes(units, size)
        longest = min(size, self.vocabulary.longest)
        score = np.full((size, longest + 1, n), -np.inf)              # by start and length
        piece = np.zeros((size, longest + 1, n), np.int32)
        for start in range(size):
            h = np.zeros(n, np.uint64)
            for width in range(1, min(longest, size - start) + 1):
                h = _step(h, codes[:, start + width - 1])
                table = self.tables.get(width)
                if table is None:
                    continue
                at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
                hit = np.flatnonzero(table[0][at] == h)
                hit = hit[(table[1][at[hit]] == codes[hit, start:start + width]).all(1)]
                score[start, width, hit], piece[start, width, hit] = table[3][at[hit]], table[2][at[hit]]
        known = np.isfinite(score[:, 1]).all(0)
        ahead, back = np.full((size + 1, n), -np.inf), np.full((size + 1, n), -np.inf)
        ahead[0], back[size] = 0.0, 0.0
        width_of = np.zeros((size + 1, n), np.int64)
        for end in range(1, size + 1):
            for width in range(1, min(longest, end) + 1):
                x = ahead[end - width] + score[end - width, width]
                better = x > ahead[end]
                ahead[end] = np.where(better, x, ahead[end])
                width_of[end] = np.where(better, width, width_of[end])
        for start in range(size - 1, -1, -1):
            for width in range(1, min(longest, size - start) + 1):
                back[start] = np.maximum(back[start], score[start, width] + back[start + width])
        # walk back; what is left of the edges then is not on the best path
        ids, counts, at, every = np.zeros((size, n), np.int32), np.zeros(n, np.int64), np.full(n, size), np.arange(n)
        while True:
            live = np.flatnonzero((at > 0) & known)
            if not len(live):
                break
            width = width_of[at[live], live]
            at[live] -= width
            ids[counts[live], live] = piece[at[live], width, live]
            counts[live] += 1
            score[at[live], width, live] = -np.inf
        second = np.full(n, -np.inf)
        for start in range(size):
            for width in range(1, min(longest, size - start) + 1):
                second = np.maximum(second, ahead[start] + score[start, width] + back[start + width])
        rows = np.maximum(counts[None, :] - 1 - np.arange(size)[:, None], 0)
        gap = np.subtract(ahead[size], second, out=np.full(n, np.inf), where=np.isfinite(second))
        return known, ids[rows, every].T, counts, ahead[size], gap


def _codes(units: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(units), size)


def _step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    return (h ^ code.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)


def _hash(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        h = _step(h, codes[:, k])
    return h


class Encoder:
    """Encodes texts; units already solved are kept while the task runs."""

    def __init__(self, vocabulary: Vocabulary, best: int = BEST, cache_units: int | None = None, solve_units: int | None = None):
        self.vocabulary, self.best, self.lattices = vocabulary, best, Lattices(vocabulary)
        self.cache_units, self.solve_units = cache_units or _CACHE_UNITS, solve_units or _SOLVE_UNITS
        # characters of line and tab white space that no piece holds are units of their own
        loose = "".join(c for c in "\n\r\t\x0b\x0c" if not any(c in p for p in vocabulary.ids))
        self.unit = re.compile(f"{MARK}*[^{MARK}{loose}]+|{MARK}+" + (f"|[{loose}]" if loose else ""))
        self.clear()

    def clear(self):
        self.code, self.units, self.ways = {}, [], {}
        self.flat, self.lens = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        self.first, self.gap = [np.empty(0)], [np.empty(0)]
        self.arrays = None

    def learn(self, units) -> None:
        """Solve units that are not known yet: short ones many at a time, the others one by one."""
        new = [u for u in units if u not in self.code]
        if not new:
            return
        self.arrays = None
        by_length: dict[int, list] = {}
        for u in new:
            by_length.setdefault(len(u), []).append(u)
        single = []
        for size, same in by_length.items():
            if size > _LONG_UNIT:
                single += same
                continue
            for at in range(0, len(same), self.solve_units):
                part = same[at:at + self.solve_units]
                known, ids, counts, best, gap = self.lattices.solve(part)
                single += [u for u, k in zip(part, known) if not k]
                self._keep([u for u, k in zip(part, known) if k], ids[known][np.arange(ids.shape[1]) < counts[known][:, None]], counts[known], best[known], gap[known])
        for u in single:
            options = self.vocabulary.nbest(u, max(2, self.best))
            self._keep([u], np.array(options[0][1], np.int32), np.array([len(options[0][1])]), np.array([options[0][0]]),
                       np.array([options[0][0] - options[1][0] if len(options) > 1 else np.inf]))

    def _keep(self, units, flat, lens, first, gap):
        for u in units:
            self.code[u] = len(self.units)
            self.units.append(u)
        self.flat.append(np.asarray(flat, np.int32))
        self.lens.append(np.asarray(lens, np.int64))
        self.first.append(first)
        self.gap.append(gap)

    def _tables(self):
        if self.arrays is None:
            self.flat, self.lens, self.first, self.gap = ([np.concatenate(x)] for x in (self.flat, self.lens, self.first, self.gap))
            self.arrays = self.flat[0], np.concatenate(([0], np.cumsum(self.lens[0]))), self.first[0], self.gap[0]
        return self.arrays

    def options(self, code: int) -> list[tuple[float, tuple]]:
        """Segmentations of a unit, its stored best one first."""
        if code not in self.ways:
            flat, offsets, first, _ = self._tables()
            own = tuple(flat[offsets[code]:offsets[code + 1]].tolist())
            found = [o for o in self.vocabulary.nbest(self.units[code], self.best) if o[1] != own]
            self.ways[code] = [(float(first[code]), own), *found][: self.best]
        return self.ways[code]

    def encode(self, text: str | None):
        """``(ids, score, nbest)`` of one text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts):
        """``(ids, score, nbest)`` per text; nbest holds the further segmentations as changes of the best one."""
        if len(self.units) > self.cache_units:
            self.clear()
        split = [self.unit.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(dict.fromkeys(u for units in split for u in units))
        code = self.code
        for units in split:
            if not units:
                yield np.empty(0, np.int32), 0.0, []
                continue
            yield self._encode(np.fromiter(map(code.__getitem__, units), np.int64, len(units)))

    def _encode(self, codes: np.ndarray):
        flat, offsets, first, gap = self._tables()
        lens = offsets[codes + 1] - offsets[codes]
        starts = np.cumsum(lens) - lens
        ids = flat[np.repeat(offsets[codes] - starts, lens) + np.arange(int(lens.sum()))]
        score, gaps = float(first[codes].sum()), gap[codes]
        near = min(self.best - 1, len(gaps))
        if near <= 0:
            return ids, score, []
        # the places of least loss, earlier ones first among equals
        limit = np.partition(gaps, near - 1)[near - 1]
        places = np.flatnonzero(gaps < limit).tolist()
        places = sorted(places + np.flatnonzero(gaps == limit)[: near - len(places)].tolist())
        choices = []
        for p in places:
            options = self.options(int(codes[p]))
            choices.append((p, [(options[0][0] - s, o) for s, o in options]))
        nbest = []
        for loss, changes in combine(choices, self.best)[1:]:
            edits = [{"at": int(starts[p]), "gone": int(lens[p]), "ids": list(self.options(int(codes[p]))[n][1])} for p, n in changes]
            nbest.append({"score": score - loss, "n_pieces": int(len(ids) + sum(len(e["ids"]) - e["gone"] for e in edits)), "changes": edits})
        return ids, score, nbest


def apply_changes(ids, changes) -> list[int]:
    """The segmentation that a further ``nbest`` entry stands for."""
    out, at = [], 0
    for c in changes:
        out += [*ids[at:c["at"]], *c["ids"]]
        at = c["at"] + c["gone"]
    return [int(x) for x in [*out, *ids[at:]]]


def encode_documents(docs: DataFrame, model_path: str = MODEL, best: int = BEST, id_col: str = "doc_id", text_col: str = "text",
                     cache_units: int = _CACHE_UNITS, chunk_chars: int = _CHUNK_CHARS, solve_units: int = _SOLVE_UNITS) -> DataFrame:
    """One row of ``SCHEMA`` per row of ``docs``; ``round_trip`` tells whether decoding gives the text back.
    The three bounds trade memory for time and change no result."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))        # the model's pieces: bounded, plain data

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        vocabulary = Vocabulary(*shared.value)
        encoder = Encoder(vocabulary, best, cache_units, solve_units)
        for batch in batches:
            row, texts = 0, batch.column(1)
            while row < batch.num_rows:
                begin, chars, held = row, 0, []
                while row < batch.num_rows and chars < chunk_chars:
                    held.append(texts[row].as_py() or "")
                    chars += len(held[-1])
                    row += 1
                ids, scores, nbest = zip(*encoder.encode_all(held))
                same = [vocabulary.decode(found.tolist()) == text for found, text in zip(ids, held)]
                lens = np.array([len(x) for x in ids], np.int32)
                offsets = np.concatenate(([0], np.cumsum(lens))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, row - begin), pa.array(lens), pa.array(scores, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids))),
                    pa.array(nbest, _NBEST), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "score", "ids", "nbest", "round_trip"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, SCHEMA)


def decode_documents(encoded: DataFrame, model_path: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``text`` decoded from its ids (null ids give null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(model_path))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(*shared.value)
        for ids in batches:
            yield ids.map(lambda x: None if x is None else vocabulary.decode(x))

    return encoded.withColumn("text", decode(F.col(ids_col)))
