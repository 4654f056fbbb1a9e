"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (id, text) or (id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def groups(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def near_duplicates(texts):
    """{id: (set size, component)} from {id: text}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[k + 1:]}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    roots = groups(links, sets)
    return {i: (len(s), roots[i]) for i, s in sets.items()}


def repeated_words(text):
    words = WORD.findall(text or "")
    seen = defaultdict(list)
    for i in range(len(words) - 4):
        seen[tuple(words[i:i + 5])].append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)})
