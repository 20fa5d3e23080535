"""Brute-force versions, straight from the definitions."""

import xxhash


def union_find(nodes, edges):
    """Node -> smallest node reachable."""
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


def fingerprint(text, n):
    found = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def groups(ids, prints, bits):
    """The smallest non-null id of each row's component."""
    rows = range(len(prints))
    roots = union_find(rows, [(i, j) for i in rows for j in rows if i < j and (prints[i] ^ prints[j]).bit_count() <= bits])
    return [min((ids[j] for j in rows if roots[j] == roots[i] and ids[j] is not None), default=None) for i in rows]
