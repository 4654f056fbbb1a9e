"""Spelling variants: words one edit apart, found by bit-sliced indexes of positions and letters."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shipping import in_arrow
from martloom.session import materialise

#: Letters of a run; A-Z alone are lower-cased.
LETTERS, UPPER = "[A-Za-z\\u00C0-\\u00FF]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_LENGTH, LEAST_COUNT, MISPRINT = 5, 3, 97
#: Words of an index; a larger group of words with one half in common is taken apart by the place of the edit.
INDEX, LARGE = 1024, 1024


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", misprint: int = MISPRINT, least: int = 1) -> DataFrame:
    """One row per run of ``least`` letters or more of every whole text, lower-cased (A-Z), with some letters lost.

    Let h be the crc32 of ``<key>:<run>``; where ``misprint`` divides h, the run's character h % length goes. A null key is
    written as nothing; null texts have no runs.
    """
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(LETTERS), F.lit(0))
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"), F.explode(found).alias("run"))
    rows = rows.filter(F.length("run") >= least).withColumn("run", F.translate("run", UPPER, UPPER.lower()))
    rows = rows.withColumn("h", F.crc32(F.concat("k", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % misprint == 0, lost).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of enough letters that stand often enough. Counts combine before the shuffle."""
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _halves(words: DataFrame) -> DataFrame:
    """Every word under its keys: (m, side, half, asks) and the stretch of common beginnings that a pair is looked for in.

    Two words one edit apart, the shorter of m letters, agree in m // 2 letters at the beginning or at the end. A word
    meets those as long as itself or one letter longer under its own length (``asks``), and shorter ones under theirs.
    A pair counts where its common beginning has ``lo`` letters or more and less than ``hi``, so under one key alone.
    """
    size = F.length("word")
    member = lambda m, asks: F.struct(m.cast("int").alias("m"), F.lit(asks).alias("asks"))
    rows = words.select("word", "n", F.explode(F.array(member(size, True), member(size - 1, False))).alias("c"))
    rows = rows.filter("c.m > 0").select("word", "n", "c.*", F.floor(F.col("c.m") / 2).cast("int").alias("k"))
    side = lambda name, half, lo, hi: F.struct(F.lit(name).alias("side"), half.alias("half"), lo.alias("lo"), hi.alias("hi"))
    sides = F.array(side("a", F.substring("word", F.lit(1), F.col("k")), F.col("k"), F.lit(None).cast("int")),
                    side("z", F.substring("word", F.length("word") - F.col("k") + 1, F.col("k")), F.lit(0), F.col("k")))
    rows = rows.select("word", "n", "m", "asks", F.explode(sides).alias("s")).select("word", "n", "m", "asks", "s.*")
    return rows.filter("hi IS NULL OR hi > 0")


def _grouped(words: DataFrame, large: int) -> DataFrame:
    """(word, n, m, asks, group, lo, hi). A group of more than ``large`` words is taken apart by the place of the edit.

    Its words come under what stands before and after each possible place j, where the pairs with a common beginning of j
    letters agree; so such a group is bounded by the square of the alphabet, whatever the number of words.
    """
    rows = _halves(words)
    sizes = rows.groupBy("m", "side", "half").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > large)
    rows = rows.join(sizes.withColumn("big", F.lit(True)).drop("size"), ["m", "side", "half"], "left")
    small = rows.filter(F.col("big").isNull()).select(
        "word", "n", "m", "asks", F.concat("side", F.lit(":"), "half").alias("group"), "lo", "hi")
    top = F.coalesce("hi", "m") - 1
    j = rows.filter("big").select("word", "n", "m", "asks", F.explode(F.sequence(F.col("lo"), top)).alias("j"))
    after = F.col("m") - 1 - F.col("j")
    rest = F.concat(F.col("j"), F.lit(":"), F.substring("word", F.lit(1), F.col("j")), F.lit("."),
                    F.substring("word", F.length("word") - after + 1, after))
    last = F.when(F.col("j") < F.col("m") - 1, F.col("j") + 1)
    return small.unionByName(j.select("word", "n", "m", "asks", F.concat(F.lit("j:"), rest).alias("group"),
                                      F.col("j").alias("lo"), last.cast("int").alias("hi")))


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of truth values as rows of 64-bit words."""
    width = -(-rows.shape[1] // 64) * 64
    full = np.zeros((len(rows), width), bool)
    full[:, :rows.shape[1]] = rows
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


def near_in_index(words: list[str], group: np.ndarray, asks: np.ndarray, m: int, lo: np.ndarray,
                  hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asking word of m letters, other word of m or m + 1) one edit apart, within groups.

    For every place and letter a bitset tells which words have it there. All asking words are read at once, letter by
    letter, and each carries three bitsets: the words that agree so far, those with one letter replaced, and those with
    one letter more, which are looked at one place further on. (One letter less is the same pair asked the other way.)
    ``lo`` and ``hi`` bound the common beginning; ``hi`` below 0 does not.
    """
    n = len(words)
    letters = np.zeros((n, m + 1), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, n)
    for size in (m, m + 1):
        at = np.flatnonzero(sizes == size)
        text = "".join(words[i] for i in at).encode("utf-32-le")
        letters[at, :size] = np.frombuffer(text, np.uint32).reshape(len(at), size)
    who = np.flatnonzero(asks)
    own = _bits(group[who][:, None] == group[None, :])
    same, more = _bits((sizes == m)[None, :]), _bits((sizes == m + 1)[None, :])
    agree, swapped, longer = own.copy(), np.zeros_like(own), np.zeros_like(own)
    at_lo, below_hi = np.zeros_like(own), np.zeros_like(own)

    def having(place: int, letter: np.ndarray) -> np.ndarray:
        """For every asking word the bitset of the words with its letter at a place."""
        kinds, which = np.unique(letter, return_inverse=True)
        return _bits(letters[:, place][None, :] == kinds[:, None])[which]

    for i in range(m):
        start, end = lo[who] == i, hi[who] == i
        at_lo[start], below_hi[end] = agree[start], agree[end]
        letter = letters[who, i]
        here = having(i, letter)
        longer = (longer | agree) & having(i + 1, letter)
        swapped = (swapped & here) | (agree & ~here)
        agree &= here
    found = ((swapped & same) | ((longer | agree) & more)) & at_lo & ~below_hi
    row, other = np.nonzero(np.unpackbits(found.view(np.uint8), axis=1, count=n, bitorder="little"))
    return who[row], other


def _spans(m: np.ndarray, group: np.ndarray, index: int, last: bool) -> list[tuple[int, int]]:
    """Cuts sorted rows into indexes of whole groups of one length; without ``last`` the last group waits for more rows."""
    new = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (group[1:] != group[:-1]))).tolist()
    ends = [*new[1:], *([len(m)] if last else [])]
    spans: list[tuple[int, int]] = []
    for lo, hi in zip(new, ends):
        if spans and m[spans[-1][0]] == m[lo] and hi - spans[-1][0] <= index:
            spans[-1] = (spans[-1][0], hi)
        else:
            spans.append((lo, hi))
    return spans


def _found(part: pa.Table, group: np.ndarray) -> pa.RecordBatch:
    """The words of an index that have near words, how many, and the most frequent."""
    words, n, m = part["word"].to_pylist(), part["n"].to_numpy(), part["m"][0].as_py()
    a, b = near_in_index(words, group, part["asks"].to_numpy(), m, part["lo"].to_numpy(), part["hi"].fill_null(-1).to_numpy())
    # A longer word does not ask: it is told by the shorter one.
    longer = np.fromiter(map(len, words), np.int64, len(words))[b] > m
    a, b = np.append(a, b[longer]), np.append(b, a[longer])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=lambda i: (-n[i], words[i]))] = np.arange(len(words))
    by = np.lexsort((rank[b], a))
    who, first, count = np.unique(a[by], return_index=True, return_counts=True)
    best = b[by][first]
    pairs = pa.StructArray.from_arrays([pa.array(-n[best]), pa.array([words[i] for i in best], pa.string())], ["less", "form"])
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in who], pa.string()), pa.array(count.astype(np.int64)), pairs], ["word", "n_near", "best"])


def _matches(rows: DataFrame, index: int) -> DataFrame:
    """(word, n_near, best): of every word and index it meets near words in, how many, and the most frequent of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _and_last(batches):
            last = batch is None
            held = held if last else pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if held is None or not held.num_rows or (held.num_rows < index and not last):
                continue
            group = held["group"].combine_chunks().dictionary_encode().indices.to_numpy()
            spans = _spans(held["m"].to_numpy(), group, index, last)
            for lo, hi in spans:
                part = held.slice(lo, hi - lo)
                if hi - lo > 1 and part["asks"].to_numpy().any():
                    yield _found(part, group[lo:hi])
            held = held.slice(spans[-1][1]) if spans else held

    return in_arrow(rows, work, "word string, n_near long, best struct<less:long,form:string>")


def _and_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_words(words: DataFrame, index: int = INDEX, large: int = LARGE) -> DataFrame:
    """(word, n_near, form, form_count): of every word with near words, how many, and the most frequent (ties: first)."""
    rows = _grouped(words, large).repartition("m", "group").sortWithinPartitions("m", "group")
    found = _matches(rows.select("word", "n", "m", "asks", "group", "lo", "hi"), index)
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_count"))


def spelling_forms(words: DataFrame, times: int = 2, index: int = INDEX, large: int = LARGE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a vocabulary (word, n) with different, non-empty words.

    Two words are near if one letter inserted, deleted or replaced turns one into the other. A word's form is its most
    frequent near word (ties: first in code-point order) if that stands ``times`` as often; the root is the end of the
    chain of forms. Counts grow along a chain, which bounds its length; pointers are doubled until the longest is done.
    Rows with a null word or count take no part. An empty vocabulary gives no rows.

    Words come together under half of their letters, in groups of any size: those above ``large`` are taken apart. Groups
    are dealt out by Spark and packed into indexes of ``index`` words; no pair leaves a task, only counts and the best.
    """
    if times < 2:
        raise ValueError("forms must stand at least twice as often, else chains could be endless")
    words = materialise(words.filter("word IS NOT NULL AND n IS NOT NULL").select("word", "n"), "vocabulary")
    near = words.join(near_words(words, index, large), "word", "left")
    formed = F.col("form_count") >= F.lit(times) * F.col("n")
    near = materialise(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                   F.when(formed, F.col("form")).alias("form"),
                                   F.when(formed, F.col("form_count")).alias("form_n")), "near-words")
    linked = near.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    most = near.agg(F.max("n")).first()[0] or 1
    for _ in range(max(0, math.ceil(math.log2(max(1, math.log(most, times)))))):
        onward = linked.select(F.col("word").alias("to"), F.col("to").alias("next"))
        linked = materialise(linked.join(onward, "to", "left").select("word", F.coalesce("next", "to").alias("to")), "roots")
    out = near.join(linked, "word", "left")
    return out.select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spelling variants among the words of whole texts, as ``runs``, ``vocabulary`` and ``spelling_forms`` say.

    Null and empty texts have no words; repeated documents count again; other columns are ignored.
    """
    return spelling_forms(vocabulary(runs(docs, key, text, least=LEAST_LENGTH)))
