"""A hierarchical navigable small-world graph over unit vectors, in numpy, searched for many queries at once.

Nodes are numbered so that layer ``l`` holds the first ``sizes[l]`` of them (each layer about
``1 / DEGREE`` of the one below); a layer is an array of neighbour numbers, -1 for none."""
from __future__ import annotations

import numpy as np

DEGREE = 16
BUILD_BEAM = 64
_TOP = 32
_BATCH = 256


def layer_sizes(n: int, degree: int = DEGREE) -> list[int]:
    sizes = [n]
    while sizes[-1] > _TOP:
        sizes.append(-(-sizes[-1] // degree))
    return sizes


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int,
                limit: int | None = None, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes found for each query on one layer, ``(nodes, similarities)``, best first (-1: none).

    ``entries`` is one start node per query; only nodes below ``limit`` count."""
    q, n = len(queries), limit or len(links)
    nodes = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -np.inf, np.float32)
    nodes[:, 0], sims[:, 0] = entries, np.einsum("qd,qd->q", queries, vectors[entries])
    seen = np.zeros((q, n), bool)
    seen[np.arange(q), entries] = True
    done = nodes < 0
    live = np.arange(q)
    width = min(width, beam)
    while len(live):
        # the best nodes of each beam that are not expanded yet
        score = np.where(done[live], -np.inf, sims[live])
        pick = np.argpartition(-score, width - 1, axis=1)[:, :width] if width < beam else np.broadcast_to(np.arange(beam), score.shape)
        fresh = np.take_along_axis(score, pick, 1) > -np.inf
        go = fresh.any(1)
        live, pick, fresh = live[go], pick[go], fresh[go]
        if not len(live):
            break
        chosen = np.where(fresh, np.take_along_axis(nodes[live], pick, 1), -1)
        mark = done[live]
        np.put_along_axis(mark, pick, True, 1)
        done[live] = mark
        near = np.where(chosen[:, :, None] >= 0, links[np.maximum(chosen, 0)], -1).reshape(len(live), -1)
        near = np.where(near < n, near, -1)
        row = np.repeat(np.arange(len(live)), near.shape[1]).reshape(near.shape)
        new = (near >= 0) & ~seen[live[row], np.maximum(near, 0)]
        # a node may come from several neighbours: keep one
        flat_row, flat_node = live[row[new]], near[new]
        _, first = np.unique(flat_row * np.int64(n) + flat_node, return_index=True)
        flat_row, flat_node = flat_row[first], flat_node[first]
        if not len(flat_row):
            continue
        seen[flat_row, flat_node] = True
        sim = np.einsum("nd,nd->n", queries[flat_row], vectors[flat_node]).astype(np.float32)
        # merge into the beams of the rows touched
        rows, start, count = np.unique(flat_row, return_index=True, return_counts=True)
        most = int(count.max())
        at = np.repeat(np.arange(len(rows)), count), np.arange(len(flat_row)) - np.repeat(start, count)
        more_n = np.full((len(rows), most), -1, np.int64)
        more_s = np.full((len(rows), most), -np.inf, np.float32)
        more_n[at], more_s[at] = flat_node, sim
        all_s = np.concatenate((sims[rows], more_s), 1)
        keep = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        sims[rows] = np.take_along_axis(all_s, keep, 1)
        nodes[rows] = np.take_along_axis(np.concatenate((nodes[rows], more_n), 1), keep, 1)
        done[rows] = np.take_along_axis(np.concatenate((done[rows], more_n < 0), 1), keep, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)


def descend(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, to: int, beam: int = 4) -> np.ndarray:
    """The best entry for layer ``to`` after searching the layers above it."""
    entries = np.zeros(len(queries), np.int64)
    for layer in range(len(layers) - 1, to, -1):
        entries = beam_search(vectors, layers[layer], queries, entries, beam)[0][:, 0]
    return entries


def spread_out(vectors: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Choose ``degree`` neighbours per row from candidates ordered by similarity: first those closer to
    the row than to any neighbour chosen before, then the nearest of the others."""
    b, c = cand.shape
    points = vectors[np.maximum(cand, 0)]
    between = np.einsum("bcd,bed->bce", points, points)
    chosen, worst = np.zeros((b, c), bool), np.full((b, c), -np.inf, np.float32)
    for i in range(c):
        take = (cand[:, i] >= 0) & (sims[:, i] > worst[:, i]) & (chosen.sum(1) < degree)
        chosen[:, i] = take
        worst = np.where(take[:, None], np.maximum(worst, between[:, i]), worst)
    rank = np.where(cand < 0, 3 * c, np.arange(c) + np.where(chosen, 0, c))
    order = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    out = np.take_along_axis(cand, order, 1)
    return np.pad(out, ((0, 0), (0, max(0, degree - c))), constant_values=-1)


def _by_similarity(vectors, rows, cand, keep):
    """Candidates of each row, repeats and the row itself removed, ordered by similarity, ``keep`` at most."""
    cand = np.sort(cand, axis=1)
    cand = np.where((cand == rows[:, None]) | np.concatenate((np.zeros((len(cand), 1), bool), cand[:, 1:] == cand[:, :-1]), 1), -1, cand)
    sims = np.where(cand >= 0, np.einsum("bd,bcd->bc", vectors[rows], vectors[np.maximum(cand, 0)]), -np.inf).astype(np.float32)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :keep]
    return np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> list[np.ndarray]:
    """Layers of a graph over ``vectors`` (unit rows in any random order), the lowest first."""
    vectors = np.asarray(vectors, np.float32)
    sizes = layer_sizes(len(vectors), degree)
    layers: list[np.ndarray] = [np.empty((0, 2 * degree), np.int64)] * len(sizes)
    for layer in range(len(sizes) - 1, -1, -1):
        size, links = sizes[layer], np.full((sizes[layer], 2 * degree), -1, np.int64)
        layers[layer] = links
        have = 0
        while have < size:
            batch = np.arange(have, min(size, have + max(_TOP, min(_BATCH, have))))
            cand = np.broadcast_to(batch, (len(batch), len(batch)))
            if have:
                entries = descend(vectors, layers, vectors[batch], layer)
                entries = np.where(entries < have, entries, 0)
                found = beam_search(vectors, links, vectors[batch], entries, min(beam, max(have, 1)), limit=have)[0]
                cand = np.concatenate((found, cand), 1)
            cand, sims = _by_similarity(vectors, batch, cand, beam)
            out = spread_out(vectors, cand, sims, degree)
            links[batch, :degree] = out
            _link_back(vectors, links, batch, out, degree)
            have += len(batch)
    return layers


def _link_back(vectors, links, batch, out, degree):
    src, dst = np.repeat(batch, out.shape[1]), out.reshape(-1)
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    rows, start, count = np.unique(dst, return_index=True, return_counts=True)
    if not len(rows):
        return
    more = np.full((len(rows), int(count.max())), -1, np.int64)
    more[np.repeat(np.arange(len(rows)), count), np.arange(len(dst)) - np.repeat(start, count)] = src
    cand, sims = _by_similarity(vectors, rows, np.concatenate((links[rows], more), 1), 3 * degree)
    full = (cand >= 0).sum(1) > 2 * degree
    keep = np.pad(cand[:, : 2 * degree], ((0, 0), (0, max(0, 2 * degree - cand.shape[1]))), constant_values=-1)
    if full.any():
        keep[full] = spread_out(vectors, cand[full], sims[full], 2 * degree)
    links[rows] = keep
