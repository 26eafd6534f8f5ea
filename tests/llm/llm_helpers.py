"""Plain re-computations that several test modules share."""

import re

import numpy as np
import xxhash


def folder_of(path, **frames):
    """Frames written as the tables of a folder."""
    for name, frame in frames.items():
        frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


def components_of(pairs, n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def all_links(codes, reach=3):
    return zip(*np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= reach), strict=True)


def plain_repeats(rows, width=13):
    """Removed words per row by a dictionary of all windows."""
    first = {}
    worded = [(i if i is not None else 2**63 - 1, (t or "").encode().split()) for i, t in rows]
    for i, words in worded:
        for s in range(len(words) - width + 1):
            key = tuple(words[s : s + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, words), (given_id, _) in zip(worded, rows, strict=True):
        gone = set()
        for s in range(len(words) - width + 1):
            if first[tuple(words[s : s + width])] < i:
                gone.update(range(s, s + width))
        out.append((given_id, len(words), len(gone), b" ".join(w for n, w in enumerate(words) if n not in gone).decode()))
    return out
