"""Plain formulations of what the operators compute, for small inputs."""

import re
from collections import Counter

import xxhash

SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def without_repeats(texts, length=35):
    """(n_words, n_removed, kept) of each text."""
    all_words = [words(t) for t in texts]
    counts = Counter(tuple(w[i : i + length]) for w in all_words for i in range(len(w) - length + 1))
    out = []
    for w in all_words:
        gone = {j for i in range(len(w) - length + 1) if counts[tuple(w[i : i + length])] > 1 for j in range(i, i + length)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def fingerprint(text):
    w = words(lowered(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def components(ids, marks, bits=2):
    """Least id reachable, for each row."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(ids))]
