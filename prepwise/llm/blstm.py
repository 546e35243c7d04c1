"""A bidirectional LSTM over sequences of blocks, in numpy: forward, backward through time, Adam."""
from __future__ import annotations

import numpy as np

HIDDEN = 24
PATH_BUCKETS, PATH_DIM = 1 << 14, 24
WORD_BUCKETS, WORD_DIM = 1 << 14, 8
RATE = 4e-3
WORD_SHARE = 0.02
DROP = {1: (0.2, 0.0), 2: (0.7, 0.3)}        # of path tokens and of words: share left out at most, and share of pages without any


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def start(dense: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights before training; vectors of path tokens and words that training never meets stay zero."""
    r = np.random.default_rng(seed)
    size = dense + PATH_DIM + WORD_DIM
    w = {"path": np.zeros((PATH_BUCKETS, PATH_DIM)), "word": np.zeros((WORD_BUCKETS, WORD_DIM)),
         "out": r.normal(0, 0.1, (2 * HIDDEN + size,)), "bias": np.zeros(1)}
    for side in "fb":
        w["x" + side] = r.normal(0, size ** -0.5, (size, 4 * HIDDEN))
        w["h" + side] = r.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
        w["b" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return {k: v.astype(np.float32) for k, v in w.items()}


def _run(x, mask, wx, wh, b, back, keep):
    """States ``(steps, rows, hidden)`` of one direction; padding at the ends of rows holds the state at zero."""
    steps, rows, _ = x.shape
    z = (x.reshape(steps * rows, -1) @ wx + b).reshape(steps, rows, -1)
    h = np.zeros((rows, HIDDEN), x.dtype)
    c = np.zeros((rows, HIDDEN), x.dtype)
    states = np.empty((steps, rows, HIDDEN), x.dtype)
    trail = [None] * steps
    for t in range(steps - 1, -1, -1) if back else range(steps):
        g = z[t] + h @ wh
        gates, new = _sigmoid(g[:, :3 * HIDDEN]), np.tanh(g[:, 3 * HIDDEN:])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        old_h, old_c = h, c
        c = (f * c + i * new) * mask[t]
        squashed = np.tanh(c)
        h = o * squashed * mask[t]
        states[t] = h
        if keep:
            trail[t] = (old_h, old_c, i, f, o, new, squashed)
    return states, trail


def _run_back(x, mask, wx, wh, d_states, trail, back):
    """Gradients of one direction: of the inputs and of its three weights."""
    steps, rows, size = x.shape
    dz = np.empty((steps, rows, 4 * HIDDEN), x.dtype)
    d_wh = np.zeros_like(wh)
    dh = np.zeros((rows, HIDDEN), x.dtype)
    dc = np.zeros((rows, HIDDEN), x.dtype)
    for t in range(steps) if back else range(steps - 1, -1, -1):
        old_h, old_c, i, f, o, new, squashed = trail[t]
        dh = (dh + d_states[t]) * mask[t]
        dc = (dc + dh * o * (1 - squashed ** 2)) * mask[t]
        dz[t] = np.concatenate([dc * new * i * (1 - i), dc * old_c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new ** 2)], 1)
        d_wh += old_h.T @ dz[t]
        dh = dz[t] @ wh.T
        dc = dc * f
    flat = dz.reshape(steps * rows, -1)
    return (flat @ wx.T).reshape(steps, rows, size), x.reshape(steps * rows, -1).T @ flat, d_wh, flat.sum(0)


def logits(w: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """``(steps, rows)`` log-odds of blocks given as ``(steps, rows, size)``."""
    f, _ = _run(x, mask, w["xf"], w["hf"], w["bf"], False, False)
    b, _ = _run(x, mask, w["xb"], w["hb"], w["bb"], True, False)
    return np.concatenate([f, b, x], 2) @ w["out"] + w["bias"]


def sums(table: np.ndarray, keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the vectors of ``keys`` per owner (ascending); an owner without keys gets zeros."""
    out = np.zeros((n, table.shape[1]), table.dtype)
    if len(keys):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[first]] = np.add.reduceat(table[keys], first, axis=0)
    return out


def inputs(w, dense, paths, words) -> np.ndarray:
    """Input vectors of blocks: plain figures, the squashed sum of the path, the mean of the words."""
    n = len(dense)
    mean = sums(w["word"], *words, n) / np.maximum(np.bincount(words[1], minlength=n), 1)[:, None]
    return np.concatenate([dense, np.tanh(sums(w["path"], *paths, n)), mean], 1).astype(np.float32)


def train(examples: list, dense: int, epochs: int, rows: int = 32, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights fitted to ``examples``: per page ``(dense, paths, words, labels)`` with ``paths`` and ``words`` as
    ``(keys, block of each)``.  Path tokens and words drop out at random, so that the context must do."""
    w = start(dense, seed)
    examples = _common_words(examples)
    r = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    step, total = 0, epochs * -(-len(examples) // rows)
    for _ in range(epochs):
        order = sorted(r.permutation(len(examples)), key=lambda k: len(examples[k][3]) // 8)       # alike lengths together
        groups = [order[a:a + rows] for a in range(0, len(order), rows)]
        for g in r.permutation(len(groups)):
            step += 1
            grads = _gradients(w, [examples[k] for k in groups[g]], r)
            rate = RATE * min(1, step / 20) * (1 - 0.9 * step / total)
            for k, d in grads.items():
                m[k] += 0.1 * (d - m[k])
                v[k] += 0.01 * (d * d - v[k])
                w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)
    return w


def _common_words(examples: list) -> list:
    """The examples without words that stand in fewer than ``WORD_SHARE`` of them, which only tell pages apart."""
    seen = np.zeros(WORD_BUCKETS, np.int64)
    for e in examples:
        seen[np.unique(e[2][0])] += 1
    common = seen >= WORD_SHARE * len(examples)
    return [(d, p, (keys[common[keys]], owner[common[keys]]), labels) for d, p, (keys, owner), labels in examples]


def _gradients(w, pages, r) -> dict[str, np.ndarray]:
    steps = max(len(p[3]) for p in pages)
    spot = np.concatenate([np.arange(len(p[3])) * len(pages) + k for k, p in enumerate(pages)])     # of a block in (step, row)
    first = np.cumsum([0, *[len(p[3]) for p in pages]])
    dense = np.concatenate([p[0] for p in pages])
    kept = []
    for at, (share, none) in DROP.items():
        keys = np.concatenate([p[at][0] for p in pages])
        owner = np.concatenate([p[at][1] + first[k] for k, p in enumerate(pages)])
        least = np.where(r.random(len(pages)) < none, 1.0, share * r.random(len(pages)))
        stay = r.random(len(keys)) >= np.repeat(least, [len(p[at][0]) for p in pages])
        kept.append((keys[stay], owner[stay]))
    flat = inputs(w, dense, *kept)
    size, n = flat.shape[1], len(dense)
    x = np.zeros((steps * len(pages), size), np.float32)
    x[spot] = flat
    x = x.reshape(steps, len(pages), size)
    mask = np.zeros(steps * len(pages), np.float32)
    mask[spot] = 1
    mask = mask.reshape(steps, len(pages), 1)
    label = np.zeros(steps * len(pages), np.float32)
    label[spot] = np.concatenate([p[3] for p in pages])
    f, trail_f = _run(x, mask, w["xf"], w["hf"], w["bf"], False, True)
    b, trail_b = _run(x, mask, w["xb"], w["hb"], w["bb"], True, True)
    top = np.concatenate([f, b, x], 2)
    d = (_sigmoid(top @ w["out"] + w["bias"]) - label.reshape(steps, -1)) * mask[:, :, 0] / n
    out = {"out": np.tensordot(d, top, 2), "bias": np.array([d.sum()], np.float32)}
    d_top = d[:, :, None] * w["out"]
    dx = d_top[:, :, 2 * HIDDEN:].copy()
    for side, at, trail in (("f", 0, trail_f), ("b", HIDDEN, trail_b)):
        more, out["x" + side], out["h" + side], out["b" + side] = _run_back(
            x, mask, w["x" + side], w["h" + side], d_top[:, :, at:at + HIDDEN], trail, side == "b")
        dx += more
    dx = dx.reshape(-1, size)[spot]
    a = dense.shape[1]
    d_path = dx[:, a:a + PATH_DIM] * (1 - flat[:, a:a + PATH_DIM] ** 2)
    d_word = dx[:, a + PATH_DIM:] / np.maximum(np.bincount(kept[1][1], minlength=n), 1)[:, None]
    for name, (keys, owner), d_vec in (("path", kept[0], d_path), ("word", kept[1], d_word)):
        out[name] = np.zeros_like(w[name])
        np.add.at(out[name], keys, d_vec[owner].astype(np.float32))
    return out
