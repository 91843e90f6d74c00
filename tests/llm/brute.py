"""Plain versions of the operators that SQL can't express."""

import re

import xxhash


def simhash(text, shingle=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    n = len(words)
    grams = [" ".join(words[i : i + shingle]) for i in range(n - shingle + 1)] if n >= shingle else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, links):
    """Smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in parent}
