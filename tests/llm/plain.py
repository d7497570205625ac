"""Brute-force versions of the corpus operators, in plain Python."""

from __future__ import annotations

import re

import xxhash


def simhash(text: str | None, width: int = 3) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(nodes, linked) -> dict:
    """Least node reachable from each node; ``linked(a, b)`` for any two."""
    nodes = sorted(nodes)
    label = {}
    for node in nodes:
        if node in label:
            continue
        label[node], queue = node, [node]
        while queue:
            a = queue.pop()
            for b in nodes:
                if b not in label and linked(a, b):
                    label[b] = node
                    queue.append(b)
    return label
