"""Brute-force versions for small tables."""

from __future__ import annotations


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


def similar(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def components(ids, linked):
    """Smallest id reachable, by ids and pairs of ids."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def jaccard_links(rows):
    """doc_id -> (n_shingles, component_id) of rows of (doc_id, text)."""
    sets = [(i, shingles(t)) for i, t in rows]
    index: dict = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(k)
    pairs = {(a, b) for ks in index.values() for n, a in enumerate(ks) for b in ks[n + 1 :]}
    linked = [(sets[a][0], sets[b][0]) for a, b in pairs if similar(sets[a][1], sets[b][1])]
    found = components([i for i, _ in rows], linked)
    return {i: (len(s), found[i]) for i, s in sets}


def without_repeats(rows, window=50):
    """doc_id -> (kept bytes, removed, spans) of rows of (doc_id, text)."""
    least: dict = {}
    for i, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - window + 1):
            part = data[k : k + window]
            least[part] = min(least.get(part, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - window + 1):
            if least[data[k : k + window]] < i:
                gone[k : k + window] = b"\1" * window
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, kept, sum(gone), runs))
    return sorted(out)
