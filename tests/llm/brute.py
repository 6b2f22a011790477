"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import itertools


def words(text):
    return (text or "").lower().split()


def shingles(text, n=5):
    w = words(text)
    return frozenset(" ".join(w[k:k + min(n, len(w))]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def similar_groups(rows, threshold=0.8):
    """(class, links) of each (doc_id, text), by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    up, links = list(range(len(rows))), collections.Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] == sets[b] or shared and shared >= threshold * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(rows[k][0])
    first = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [(first[root(k)], links[k]) for k in range(len(rows))]


def without_repeats(rows, length=400):
    raws = [(t or "").encode() for _, t in rows]
    places = collections.defaultdict(list)
    for k, raw in enumerate(raws):
        for p in range(len(raw) - length + 1):
            places[raw[p:p + length]].append((k, p))
    gone = [bytearray(len(r)) for r in raws]
    for at in places.values():
        if len(at) > 1:
            for k, p in at:
                gone[k][p:p + length] = b"\1" * length
    out = []
    for (doc_id, _), raw, g in zip(rows, raws, gone, strict=True):
        kept = bytes(b for b, x in zip(raw, g, strict=True) if not x)
        spans = sum(1 for k in range(len(g)) if g[k] and (k == 0 or not g[k - 1]))
        out.append((doc_id, len(raw), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edit_distance(item, text):
    """Of a word list to the nearest stretch of another."""
    row = [0] * (len(text) + 1)
    for k, w in enumerate(item):
        new = [k + 1]
        for j, v in enumerate(text):
            new.append(min(row[j] + (w != v), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)
