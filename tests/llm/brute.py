"""Plain Python versions of what the operators compute."""

import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) >= width:
        return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def grams(line, width=8):
    return frozenset(line[k : k + width] for k in range(max(1, len(line) - width + 1)))


def components(sets, percent):
    """Name -> least name reachable over similar sets; empty sets link with nothing."""
    parent = {name: name for name in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(a, b):
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)

    holders = defaultdict(list)
    for name, values in sets.items():
        common = Counter()
        for v in values:
            common.update(holders[v])
            holders[v].append(name)
        for other, both in common.items():
            if 100 * both >= percent * (len(values) + len(sets[other]) - both):
                link(name, other)
    return {name: top(name) for name in sets}


def lines(rows):
    """(doc_id, line_no) -> shingles of the lines that are not blank."""
    out = {}
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(SPACE):
                out[doc_id, k] = grams(line.translate(LOWER))
    return out


def variants(seed, n, words, edits, vocabulary=400):
    """Texts that are edits of one text: the near copies of a large group."""
    import random

    draw = random.Random(seed)
    base = [f"w{draw.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(copy))
    return out
