"""Plain versions of what the operators compute, for small inputs."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1))


def groups(nodes, linked):
    """Node to the smallest node reachable."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(sets, percent):
    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                yield a, b


def line_dedup(rows, window=3):
    """Texts by doc_id after the removal; ids are unique."""
    places = defaultdict(list)
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        lines = [] if text is None else text.split("\n")
        for i in range(len(lines) - window + 1):
            if any(line.strip(" \t\r\f\x0b") for line in lines[i : i + window]):
                places[tuple(lines[i : i + window])].append((doc_id, i))
    gone = defaultdict(set)
    for found in places.values():
        for doc_id, i in found[1:]:
            gone[doc_id].update(range(i, i + window))
    return {
        doc_id: None if text is None else "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone[doc_id])
        for doc_id, text in rows
    }


def repeated_bytes(texts, length):
    """(size, removed, spans, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if cover[i] and (i == 0 or not cover[i - 1]))
        out.append((len(b), sum(cover), spans, bytes(x for x, c in zip(b, cover, strict=True) if not c)))
    return out


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))
