"""Plain versions of the vector operators: every distance, Python integers, a row at a time."""

import hashlib
import math


def whole(vector, limit=32_768.0):
    return vector is not None and all(x is not None and abs(x) < limit for x in vector)


def integer(vector):
    return tuple(math.floor(float(x) * 1024) for x in vector)


def distance(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(entries, v):
    """(index, squared distance), ties to the lower index."""
    d, i = min((distance(e, v), i) for i, e in enumerate(entries))
    return i, d


def refined(entries, vectors):
    groups = {}
    for v in vectors:
        groups.setdefault(nearest(entries, v)[0], []).append(v)
    return [tuple(sum(c) // len(c) for c in zip(*groups[i])) if i in groups else e for i, e in enumerate(entries)]


def _order(row):
    return (row[0] is None, row[0] or 0, row[1])


def product_codes(rows, dims, parts=4, entries=256, rounds=4):
    """Rows (key, vector, label) -> sorted (key, code, error, label_error, digest)."""
    kept = [(k, integer(v), label) for k, v, label in rows if whole(v) and len(v) == dims]
    width = dims // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    first = sorted(kept, key=_order)[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]
    for _ in range(rounds):
        books = [refined(b, [cut(v)[p] for _, v, _ in kept]) for p, b in enumerate(books)]
    h = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(k, [nearest(b, x) for b, x in zip(books, cut(v))], label) for k, v, label in kept]
    per = {}
    for _, found, label in coded:
        per[label] = per.get(label, 0) + sum(d for _, d in found)
    return sorted(((k, "".join(f"{i:02x}" for i, _ in found), sum(d for _, d in found), per[label], h) for k, found, label in coded), key=repr)


def clusters(rows, dims=64, k=8, rounds=10):
    """Rows (key, vector) -> sorted (key, cluster, distance, cluster_inertia, inertia, digest)."""
    kept = [(key, integer(v)) for key, v in rows if whole(v) and len(v) == dims]
    digest = lambda key: hashlib.sha256(f"3:{key}".encode()).hexdigest()
    start = sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]
    centroids = [v for _, v in start]
    for _ in range(rounds):
        centroids = refined(centroids, [v for _, v in kept])
    found = [(key, *nearest(centroids, v)) for key, v in kept]
    per = [sum(d for _, c, d in found if c == i) for i in range(len(centroids))]
    h = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((key, c, d, per[c], sum(per), h[c]) for key, c, d in found), key=repr)
