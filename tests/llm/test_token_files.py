import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from plain import documents
from tokenizers import Tokenizer

from martloom.llm import catalog, token_files
from martloom.llm.wavelet import Wavelet, build

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("kinds", [1, 2, 7, 3000, 2**31])
@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_image_answers_like_the_sequence(kinds, n):
    rng = np.random.default_rng(n + kinds % 97)
    ids = (np.minimum(rng.zipf(1.3, n), kinds) - 1 if kinds < 2**31 else rng.integers(0, 2**32, n)).astype(np.uint32)
    image = Wavelet(build(ids))
    assert image.size == n and image.decode().tolist() == ids.tolist()
    for i in rng.integers(0, n, min(n, 30)).tolist() if n else ():
        token = int(ids[i])
        at = np.flatnonzero(ids == token)
        lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
        k = int(rng.integers(0, len(at)))
        assert image.access(i) == token
        assert image.count(token, lo, hi) == np.count_nonzero(ids[lo:hi] == token)
        assert image.find(token, k) == at[k] and image.find(token, len(at)) == -1
        assert image.places(token).tolist() == at.tolist()
    assert image.count(12345678) == 0 and image.find(12345678, 0) == -1 and not len(image.places(12345678))
    with pytest.raises(IndexError):
        image.access(n)


def test_image_is_about_as_large_as_the_entropy():
    share = 1 / np.arange(1, 2001)
    ids = np.random.default_rng(1).choice(2000, 200_000, p=share / share.sum())
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() * len(ids) / 8
    assert len(build(ids)) < 1.02 * entropy + 2000 * 8 + 64


def plain(rows):
    """{(id, crc): starts} and sizes in the order of the files, which is by id alone where texts differ by hash."""
    library = Tokenizer.from_file(WORDS)
    found = {}
    for key, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        found.setdefault(key, []).append((len(ids), zlib.crc32(ids.tobytes())))
    return found


def check(got, rows):
    want, start = plain(rows), 0
    for key in sorted(want, key=lambda k: (k is not None, k or 0)):
        own = sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] == key)
        assert sorted(r[1:] for r in own) == sorted(want[key])
        for first, size, _ in own:
            assert first == start
            start += size
    assert len(got) == len(rows)


def test_files_hold_every_document(spark, folder):
    rng = random.Random(2)
    rows = [(i * 7 % 1000, " ".join(rng.choices(["the", "cat", "naïve", "re-do", "##", "12"], k=rng.randrange(40)))) for i in range(300)]
    rows += [(3, None), (4, ""), (None, "x y"), (None, None), (3, "same"), (3, "same"), (5, "ab" * 4000), (6, "a " * 9000)]
    docs = documents(spark, rows)
    token_files.write_token_files(docs, f"{folder}/t", WORDS, shard=500)
    check(token_files.read_token_files(spark, f"{folder}/t").collect(), rows)
    files = spark.read.parquet(f"{folder}/t").collect()
    assert len(files) > 20 and all(f["n_tokens"] - f["sizes"][-1] < 500 for f in files)
    ids = {(r["doc_id"], r["ids_crc32"]): r["ids"] for r in token_files.read_token_files(spark, f"{folder}/t", with_ids=True).collect()}
    assert all(zlib.crc32(np.array(v, "<u4").tobytes()) == c for (_, c), v in ids.items())
    ends = token_files.token_occurrences(spark, f"{folder}/t", 2).groupBy("part", "shard").count().collect()
    assert sum(r["count"] for r in ends) == sum(sum(x == 2 for x in r["ids"]) for r in token_files.read_token_files(
        spark, f"{folder}/t", with_ids=True).collect())


def test_hot_and_empty_keys(spark):
    rows = [(None if i % 3 else i, "one text" if i % 2 else f"text {i}") for i in range(900)]
    check(token_files.stored_tokens(documents(spark, rows), WORDS).collect(), rows)
    assert token_files.stored_tokens(documents(spark, []), WORDS).collect() == []
    clash = documents(spark, rows[:5]).selectExpr("*", "1 AS k", "2 AS t", "3 AS row", "4 AS part", "5 AS start", "6 AS ids_crc32")
    check(token_files.stored_tokens(clash, WORDS).collect(), rows[:5])


def test_query_returns_the_contract(spark):
    found = catalog.QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(found.collect(), [tuple(r) for r in docs])
