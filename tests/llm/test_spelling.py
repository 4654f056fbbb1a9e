import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from plain import LOWER, documents

from martloom.llm import catalog, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(rows):
    """Counts of the words of (id, text) rows, letters lost where the checksum says so."""
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return counts


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain(counts, times=2):
    """{word: (form, root, n, n_near, form_n)} by looking at all pairs."""
    forms, out = {}, {}
    for w, n in counts.items():
        others = sorted((-counts[v], v) for v in counts if near(w, v))
        best = others[0] if others and -others[0][0] >= times * n else None
        forms[w] = best[1] if best else None
        out[w] = [forms[w], w, n, len(others), -best[0] if best else None]
    for w in out:
        while forms[out[w][1]]:
            out[w][1] = forms[out[w][1]]
    return {w: tuple(v) for w, v in out.items()}


def result(frame):
    rows = frame.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def random_words(rng, n, letters, most):
    base = {"".join(rng.choices(letters, k=rng.randrange(1, most))) for _ in range(n)}
    for w in list(base)[:n // 2]:
        i = rng.randrange(len(w))
        base |= {w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]}
    return {w: rng.choice([1, 1, 2, 3, 5, 9, 20, 81]) for w in base if w}


@pytest.mark.parametrize("letters, most, large, index", [
    ("ab", 9, 10**6, 64), ("ab", 9, 3, 8), ("abcdeé漢𝔘", 7, 10**6, 1024), ("abcdeé漢𝔘", 7, 5, 100), ("aaab", 14, 20, 16)])
def test_forms_equal_all_pairs(spark, letters, most, large, index):
    counts = random_words(random.Random(most * large), 150, letters, most)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(spelling.spelling_forms(words, index=index, large=large)) == plain(counts)


def test_index_follows_one_error_in_every_place():
    words = ["about", "abouts", "abut?", "xabout", "abott", "about"[::-1], "boutx", "aboutt", "aabout"]
    m, asks = 5, np.array([len(w) == 5 for w in words])
    none, group = np.full(len(words), -1), np.zeros(len(words), int)
    a, b = spelling.near_in_index(words, group, asks, m, none + 1, none)
    want = {(i, k) for i in np.flatnonzero(asks) for k, w in enumerate(words) if near(words[i], w)}
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want)


def test_long_words_and_chains(spark):
    long = "ab" * 1500
    counts = {long: 4, long[:-1]: 9, "x" + long: 2, "a" * 40: 1, "a" * 41: 2, "a" * 42: 4, "a" * 43: 8, "a" * 44: 16}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = result(spelling.spelling_forms(words))
    assert got == plain(counts) and got["a" * 40][1] == "a" * 44
    assert spelling.spelling_forms(words.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_forms(words, times=1)


def test_variants_of_texts(spark):
    rng = random.Random(8)
    vocabulary = ["there", "theré", "where", "Ñandu", "letter", "letters", "better", "x×÷zz", "naïve", "abc", "straße"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=60))) for i in range(80)]
    rows += [(None, "there letter " * 30), (None, None), (81, ""), (82, "don't-stop there1there"), (82, "x" * 5000)] + rows[:3]
    counts = {w: n for w, n in words_of(rows).items() if len(w) >= 5 and n >= 3}
    assert any(len(w) < 6 and w not in (v.translate(LOWER) for v in vocabulary) for w in words_of(rows))
    docs = documents(spark, rows)
    assert result(spelling.spelling_variants(docs)) == plain(counts)
    clash = docs.selectExpr("*", "1 AS word", "2 AS n", "3 AS k", "4 AS run", "5 AS h", "6 AS form")
    assert result(spelling.spelling_variants(clash)) == plain(counts)
    assert spelling.spelling_variants(docs.limit(0)).collect() == []


def test_query_returns_the_contract(spark):
    found = catalog.QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
