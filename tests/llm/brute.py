"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    words = WORDS.findall((text or "").translate(_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[at : at + 5]) for at in range(len(words) - 4))


def smallest_reachable(nodes, links) -> dict:
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {node: find(node) for node in nodes}


def jaccard_components(texts: dict) -> dict:
    sets = {key: shingles(text) for key, text in texts.items()}
    keys = sorted(sets)
    links = [
        (a, b)
        for at, a in enumerate(keys)
        for b in keys[at + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {key: (len(sets[key]), low) for key, low in smallest_reachable(keys, links).items()}


def leaks(texts: dict, items: dict) -> set:
    found = set()
    for key, text in texts.items():
        held = shingles(text)
        for item, wanted in items.items():
            own = shingles(wanted)
            if own and 100 * len(held & own) >= 75 * len(own):
                found.add((key, item, len(own), len(held & own)))
    return found


def without_lines(texts: dict) -> dict:
    """key: (lines, removed, text); keys are ordered documents."""
    seen, result = set(), {}
    for key in sorted(texts):
        text = texts[key]
        lines = [] if text is None else text.split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            window = tuple(lines[at : at + 3])
            if window in seen:
                gone |= {at, at + 1, at + 2}
            seen.add(window)
        kept = "\n".join(line for at, line in enumerate(lines) if at not in gone)
        result[key] = (len(lines), len(gone), None if text is None else kept)
    return result


def without_passages(texts: dict, window: int = 50) -> dict:
    """key: (words, removed, kept words)."""
    first, result = {}, {}
    for key in sorted(texts):
        words = WORDS.findall(texts[key] or "")
        gone = set()
        for at in range(len(words) - window + 1):
            if first.setdefault(tuple(words[at : at + window]), key) < key:
                gone |= set(range(at, at + window))
        result[key] = (len(words), len(gone), [word for at, word in enumerate(words) if at not in gone])
    return result


def shared_targets(sizes: dict, passes: int = 3) -> dict:
    """Targets by weight; what is above the limit is shared again until none is."""
    order = sorted(sizes, key=lambda source: (source is None, source or ""))
    weights = {source: (5, 2, 1)[at % 3] for at, source in enumerate(order)}
    limited: dict = {}
    while True:
        open_ = [source for source in order if source not in limited]
        rest = sum(sizes.values()) - sum(limited.values())
        total = sum(weights[source] for source in open_)
        aims = {source: rest * weights[source] / total for source in open_}
        above = [source for source in open_ if aims[source] > passes * sizes[source] + 1e-9]
        if not above:
            return limited | aims
        limited |= {source: float(passes * sizes[source]) for source in above}


def highest_quotients(weights: dict, seats: int) -> dict:
    won = Counter()
    for _ in range(seats):
        best = min((k for k in weights if weights[k] > 0), key=lambda k: (-weights[k] / (2 * won[k] + 1), -weights[k], k))
        won[best] += 1
    return won
