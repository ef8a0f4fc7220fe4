"""Brute-force versions to hold the operators against."""

import re

import xxhash


def simhash(text, words=3):
    toks = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not toks:
        return 0
    parts = [" ".join(toks[i : i + words]) for i in range(len(toks) - words + 1)] or [" ".join(toks)]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def component_ids(ids, fps, bits=3):
    """Smallest id of each component; all pairs are looked at."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            low[r] = min(d, low.get(r, d))
    return [low.get(find(i)) for i in range(len(ids))]


def digest_row(base, kinds):
    import hashlib

    text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
    return (*(sum(k == x for k, _, _ in base) for x in kinds), hashlib.sha256(text.encode()).hexdigest())
