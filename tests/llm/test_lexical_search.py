import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from plain import LOWER, documents

from martloom.llm import catalog, lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "item_id long, text string"


def plain(rows, items, k):
    """The k best of every item by scoring every document."""
    split = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    split = [(i, c) for i, c in split if c]
    n_docs, total = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = {}
    for item, text in items:
        scored = []
        for i, c in split:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if t in c)
            if score > 0:
                scored.append((score, i))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        if scored:
            out.setdefault(item, []).extend((r, i, s) for r, (s, i) in enumerate(scored[:k], 1))
    return out


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return {i: sorted(rows) for i, rows in out.items()}


def corpus(n, seed, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Émile", "naïve", "x-y", "漢字", "A1b", "İ"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("cells", [200, 5000, lexical_search.CELLS])
def test_ranks_like_scoring_everything(spark, monkeypatch, cells):
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    rows = corpus(500, 1)
    rows += [(600 + i, rows[3][1]) for i in range(40)] + [(700, ""), (701, None), (702, "..!"), (703, "w1 " * 30000), (None, "w2 w50 w51")]
    items = [(i, t) for i, t in corpus(12, 2)] + [(20, None), (21, ""), (22, "not there"), (23, "W2 w2, W50"), (24, "w51 w50 w59")]
    got = found(lexical_search.ranked_search(documents(spark, rows), spark.createDataFrame(items, SCHEMA), 15))
    assert got == plain(rows, items, 15)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    rows, items = corpus(120, 3), corpus(6, 4)
    got = found(lexical_search.ranked_search(documents(spark, rows), spark.createDataFrame(items, SCHEMA), 5))
    assert got == plain(rows, items, 5)


def test_tree_skips_branches_that_cannot_win():
    rng = np.random.default_rng(5)
    paths = [np.unique(rng.integers(0, 200, 12)) for _ in range(2000)]
    counts = [rng.integers(1, 4, len(p)) for p in paths]
    paths += [np.array([3, 50, 120, 199])] * 6
    counts += [np.array([9, 9, 9, 9])] * 6
    m = np.append(rng.integers(60, 200, 2000), [60] * 6)
    tree = lexical_search.Tree(paths, counts, m, 200)
    own, weights, seen = np.array([3, 50, 120, 199]), np.array([900, 2000, 3000, 4000]), []
    score = tree.scores
    tree.scores = lambda nodes, *rest: (seen.append(len(nodes)), score(nodes, *rest))[1]
    ties = np.arange(len(paths))[::-1]
    got = tree.search(own, weights, 4, 1, ties)
    assert [d for _, d in got] == [2005, 2004, 2003, 2002] and len({s for s, _ in got}) == 1
    assert sum(seen) < len(paths)


def test_empty_tables_repeats_and_clashing_names(spark):
    docs, items = documents(spark, [(1, "a b"), (1, "a b"), (1, "a c")]), spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], SCHEMA)
    clash = docs.selectExpr("*", "1 AS n", "2 AS terms", "3 AS counts", "4 AS score", "5 AS rank", "6 AS item_id", "7 AS _text")
    asked = items.selectExpr("*", "1 AS i", "2 AS t", "3 AS doc_id")
    got = found(lexical_search.ranked_search(clash, asked))
    assert got == plain([(1, "a b"), (1, "a b"), (1, "a c")], [(1, "a b"), (2, "c")], 50)
    assert lexical_search.ranked_search(docs.limit(0), items).collect() == []
    assert lexical_search.ranked_search(docs, items.limit(0)).collect() == []


def test_third_of_rows_alike(spark):
    rows = [(None if i % 3 else i, "w1 w2" if i % 3 else f"w1 w{i % 50}") for i in range(3000)]
    items = [(1, "w1 w2 w7")]
    got = found(lexical_search.ranked_search(documents(spark, rows), spark.createDataFrame(items, SCHEMA), 1500))
    assert got == plain(rows, items, 1500)


def test_query_returns_the_contract(spark):
    found_ = catalog.QUERIES["op11_lexical_search"](spark, "/root/testdata/sf0.001")
    assert dict(found_.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
