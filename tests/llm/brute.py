"""Plain Python versions of the operators' results, for small tables."""
import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def words(t):
    return WORD.findall(lower_ascii(t or ""))


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def fingerprint(t, n=3):
    w = words(t)
    if not w:
        return 0
    grams = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_components(rows):
    """``{doc_id: component}`` of ``(doc_id, text)`` with distinct ids."""
    prints = {i: fingerprint(t) for i, t in rows}
    ids = sorted(prints)
    edges = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if bin(prints[a] ^ prints[b]).count("1") <= 2]
    return prints, roots(ids, edges)


def exact_groups(rows):
    """Sorted ``(doc_id, keep_id, size, kept, sha)`` of ``(doc_id, text)``."""
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((i, t or ""))
    out = []
    for n, members in groups.items():
        members.sort(key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for k, (i, _) in enumerate(members):
            out.append((i, members[0][0], len(members), k == 0, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def targets(sizes, weights=(1, 2, 3), cap=3):
    """``{source: target}`` of ``{source: words}``: share by weight, cap, reshare the excess."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, out = sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(out.values())
    return out
