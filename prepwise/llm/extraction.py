"""Main text of web pages: a recurrent labeller that classifies every block in the light of the whole page.

A page is cut into its leaf blocks (see ``markup``).  A block's vector holds the squashed sum of
learned vectors over the elements around it (names, and the words of their classes, ids and roles),
the mean of learned vectors of its hashed words, and a few plain figures (length, share of links,
punctuation, place).  A bidirectional LSTM reads the blocks of the page in order, and each block is
kept or dropped by its own log-odds, which so depend on all other blocks.

Fit: ``TRAIN_PAGES`` pages (the smallest hashes among pages of at most ``TRAIN_CHARS`` characters that
have an article or main element) go to one task.  They say themselves which texts are the article; the
task trains on them and on ``LAYOUTS`` pages that set those texts into other layouts, and writes the
weights to the shared folder.  Without such pages it trains on invented texts.  Everything else
(every page, every block, whole texts) is read by the tasks page by page, without a shuffle.

Defined results: null or empty html gives an empty text; a page without an article gives an empty
text; rows are labelled one by one, so null ids and repeated rows stay; unclosed and cut-off markup is
taken as browsers take it; other columns are not read; an empty table gives an empty result."""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blstm
from .common import Scratch, get_array, put_array
from .layouts import Layouts, chains, own_labels
from .markup import Page, parse
from .words import batches_of, hashed_words

TRAIN_PAGES = 300
TRAIN_CHARS = 40_000
LAYOUTS = 2000
EPOCHS = 7
TRAIN_BLOCKS = 96                        # blocks of a training example; longer ones are cut into several
CELLS = 40_000                           # blocks of a stack of pages that run together, padding included
LETTERS = 4 << 20                        # characters of html that are parsed at a time
_END = frozenset('.!?…:;"”»)')
DENSE = 16


# --- vectors of blocks --------------------------------------------------------------------
def _dense(page: Page) -> np.ndarray:
    """Plain figures of every block."""
    rows, total = np.zeros((len(page.blocks), DENSE), np.float32), len(page.blocks)
    for k, (node, text, linked) in enumerate(page.blocks):
        size, words = len(text), text.count(" ") + 1
        tag = _leaf(page, node)
        rows[k] = (np.log1p(size) / 6, np.log1p(words) / 4, min(1.0, linked / size), linked >= size, text[-1] in _END, text.count(",") / words,
                   tag in ("h1", "h2", "h3", "h4", "h5", "h6"), tag == "li", tag == "p", tag == "h1", k / total, 1 / (1 + k), 1 / (total - k),
                   text[0].isupper(), sum(map(str.isdigit, text[:64])) / min(size, 64), min(2.0, page.depths[node] / 10))
    return rows


def _leaf(page: Page, node: int) -> str:
    """The innermost of the elements that make blocks."""
    while node > 0 and page.names[node] in ("a", "b", "i", "em", "strong", "span", "small", "u", "code", "font"):
        node = page.parents[node]
    return page.names[node]


def _hash(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % blstm.PATH_BUCKETS


def _word_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = hashed_words(texts)
    return (hashes % np.uint64(blstm.WORD_BUCKETS)).astype(np.int64), np.repeat(np.arange(len(texts)), counts)


def _example(page: Page, labels: list[int]) -> list[tuple]:
    """Training examples of a page: ``(dense, paths, words, labels)`` for runs of at most ``TRAIN_BLOCKS`` blocks."""
    dense, around = _dense(page), chains(page)
    found = []
    for a in range(0, len(page.blocks), TRAIN_BLOCKS):
        part = page.blocks[a:a + TRAIN_BLOCKS]
        paths = [[_hash(t) for t in around[node]] for node, _, _ in part]
        keys = (np.array([t for p in paths for t in p], np.int64), np.repeat(np.arange(len(part)), [len(p) for p in paths]))
        found.append((dense[a:a + TRAIN_BLOCKS], keys, _word_keys([t for _, t, _ in part]), np.array(labels[a:a + TRAIN_BLOCKS], np.float32)))
    return found


def train_weights(sources: list[str], n_layouts: int = LAYOUTS, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights from the html of training pages."""
    examples, articles, others = [], [], []
    for source in sources:
        page = parse(source)
        labels = own_labels(page)
        if labels and any(labels):
            examples += _example(page, labels)
            articles.append([b[1] for b, kept in zip(page.blocks, labels) if kept])
            others += [b[1] for b, kept in zip(page.blocks, labels) if not kept]
    made = Layouts(articles, others, seed)
    for _ in range(n_layouts):
        page, labels = made.example()
        if labels:
            examples += _example(page, labels)
    return blstm.train(examples, DENSE, epochs, seed=seed)


def fit(pages: DataFrame, html_col: str = "html", n_pages: int = TRAIN_PAGES, n_layouts: int = LAYOUTS, epochs: int = EPOCHS) -> str:
    """Train in one task; returns the folder of the weights in the shared folder."""
    folder = Scratch(pages.sparkSession, "blocks").folder("weights")

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"html": pd.Series(dtype=object), "h": pd.Series(dtype="int64")}), *batches])
        rows = rows.sort_values(["h", "html"])
        for name, array in train_weights(list(rows["html"]), n_layouts, epochs).items():
            put_array(f"{folder}/{name}.npy", array)
        yield pd.DataFrame({"pages": [len(rows)]})

    labelled = pages.select(F.col(html_col).cast("string").alias("html"))
    labelled = labelled.where((F.length("html") <= TRAIN_CHARS) & F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    sample = labelled.withColumn("h", F.xxhash64("html")).orderBy("h", "html").limit(n_pages)
    sample.coalesce(1).mapInPandas(train, "pages long").agg(F.sum("pages")).first()
    return folder


# --- labelling ----------------------------------------------------------------------------
class Labeller:
    """Trained weights, applied to stacks of pages."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.known: dict[str, int] = {}

    @classmethod
    def of(cls, folder: str) -> "Labeller":
        return cls({k: np.asarray(get_array(f"{folder}/{k}.npy")) for k in blstm.start(DENSE)})

    def _keys(self, tokens) -> list[int]:
        if len(self.known) > 100_000:
            self.known.clear()
        for t in tokens:
            if t not in self.known:
                self.known[t] = _hash(t)
        return [self.known[t] for t in tokens]

    def _paths(self, pages: list[Page]) -> np.ndarray:
        """Sum of the vectors along the path of every block, level by level of the trees."""
        first = np.cumsum([0, *[len(p.parents) for p in pages]])
        n = int(first[-1])
        counts = [len(t) for p in pages for t in p.tokens]
        keys = np.array([k for p in pages for t in p.tokens for k in self._keys(t)], np.int64)
        around = blstm.sums(self.w["path"], keys, np.repeat(np.arange(n), counts), n)
        parents = np.concatenate([np.array(p.parents) + first[k] for k, p in enumerate(pages)])
        depths = np.concatenate([p.depths for p in pages])
        order = np.argsort(depths, kind="stable")
        levels = np.searchsorted(depths[order], np.arange(1, depths.max() + 2))
        for a, b in zip(levels, levels[1:]):
            around[order[a:b]] += around[parents[order[a:b]]]
        return np.concatenate([around[np.array([b[0] for b in p.blocks], np.int64) + first[k]] for k, p in enumerate(pages)])

    def odds(self, pages: list[Page]) -> list[np.ndarray]:
        """Log-odds of every block of every page; pages of alike lengths run together."""
        found = [np.empty(0, np.float32)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if p.blocks), key=lambda k: len(pages[k].blocks))
        stack: list[int] = []
        for k in order:
            if stack and (len(stack) + 1) * len(pages[k].blocks) > CELLS:
                self._stack(pages, stack, found)
                stack = []
            stack.append(k)
        if stack:
            self._stack(pages, stack, found)
        return found

    def _stack(self, pages, stack, found) -> None:
        some = [pages[k] for k in stack]
        lens = [len(p.blocks) for p in some]
        words, owner = _word_keys([b[1] for p in some for b in p.blocks])
        mean = blstm.sums(self.w["word"], words, owner, sum(lens)) / np.maximum(np.bincount(owner, minlength=sum(lens)), 1)[:, None]
        flat = np.concatenate([np.concatenate([_dense(p) for p in some]), np.tanh(self._paths(some)), mean], 1).astype(np.float32)
        spot = np.concatenate([np.arange(n) * len(some) + k for k, n in enumerate(lens)])
        x = np.zeros((lens[-1] * len(some), flat.shape[1]), np.float32)
        x[spot] = flat
        mask = np.zeros(lens[-1] * len(some), np.float32)
        mask[spot] = 1
        z = blstm.logits(self.w, x.reshape(lens[-1], len(some), -1), mask.reshape(lens[-1], len(some), 1)).reshape(-1)[spot]
        for k, part in zip(stack, np.split(z, np.cumsum(lens)[:-1])):
            found[k] = part

    def texts(self, sources: list[str | None]) -> list[str]:
        """The main text of every page."""
        out = []
        for a, b in batches_of(sources, LETTERS):
            pages = [parse(s or "") for s in sources[a:b]]
            for page, z in zip(pages, self.odds(pages)):
                out.append("\n".join(block[1] for block, odds in zip(page.blocks, z) if odds > 0))
        return out


def extract(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` per page; ``folder`` are weights of ``fit``, trained on these pages by default."""
    folder = folder or fit(pages, html_col)
    taken = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = None
        for batch in batches:
            labeller = labeller or Labeller.of(folder)
            html = batch.column(2)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False)) // LETTERS
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(sizes)) + 1):
                if len(part):
                    texts = labeller.texts(html.slice(int(part[0]), len(part)).to_pylist())
                    ids, urls = (batch.column(k).slice(int(part[0]), len(part)) for k in (0, 1))
                    yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                     ["page_id", "url", "text", "n_chars"])

    id_type, url_type = taken.schema["page_id"].dataType.simpleString(), taken.schema["url"].dataType.simpleString()
    return taken.mapInArrow(label, f"page_id {id_type}, url {url_type}, text string, n_chars long")
