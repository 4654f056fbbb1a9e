"""Ranked lexical search: documents in a frequent-pattern tree, searched branch by branch for every item."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from martloom.llm.shipping import in_arrow
from martloom.session import materialise

#: Characters that part terms, as bytes; bytes from 0x80 on belong to terms, A-Z are lower-cased.
_TERM = bytes([c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
               for c in range(256)])
#: Terms of a block of items, unless one item has more; cells of a tree's tables; nodes that are looked at together.
BLOCK_TERMS, CELLS, TOGETHER = 1 << 14, 12_000_000, 256
#: Documents of a branch that is not divided further.
FEW = 64
SCALE = 1_000_000_000


def terms(text: str | None) -> list[bytes]:
    """The terms of a text: runs of digits, letters and all characters beyond ASCII; only A-Z are lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Tree:
    """The frequent-pattern tree of some documents.

    A document is the path of its terms, numbered by falling document frequency, so common terms stand on shared paths.
    Rows of ``tf`` and ``m`` are nodes: first the documents, in the order of their paths, then the nodes at which paths
    part (branches of up to ``FEW`` documents are one node), with the greatest tf of every term and the least m below them. ``first`` and ``last`` bound a node's children
    in ``child``.
    """

    def __init__(self, paths: list[np.ndarray], counts: list[np.ndarray], m: np.ndarray, n_terms: int):
        n = len(paths)
        self.order = np.array(sorted(range(n), key=lambda i: paths[i].astype(">u4").tobytes()), np.int64)
        paths, counts = [paths[i] for i in self.order], [counts[i] for i in self.order]
        shared = [0] * (n + 1)
        for i in range(1, n):
            k = min(len(paths[i - 1]), len(paths[i]))
            differ = np.flatnonzero(paths[i - 1][:k] != paths[i][:k])
            shared[i] = int(differ[0]) if len(differ) else k
        shared[n] = -1
        # A node ends where fewer terms are shared than its path has: a stack of (path length, first document, children).
        children: list[list[int]] = []

        def node(below: list[int]) -> int:
            children.append(below)
            return n + len(children) - 1

        def made(part: tuple[int, int, int | None]) -> int:
            lo, hi, number = part
            return number if number is not None else lo if hi - lo == 1 else node(list(range(lo, hi)))

        open_: list[tuple[int, int, list]] = [(0, 0, [])]
        for i in range(n):
            part = (i, i + 1, None)
            while open_ and open_[-1][0] > shared[i + 1]:
                _, lo, own = open_.pop()
                own.append(part)
                # The documents of a small branch stay together and hang on one node.
                few = i + 1 - lo <= FEW and open_
                part = (lo, i + 1, None if few else node([made(x) for x in own]))
            if open_ and open_[-1][0] < shared[i + 1]:
                open_.append((shared[i + 1], part[0], [part]))
            elif open_:
                open_[-1][2].append(part)
        self.root = n + len(children) - 1
        self.tf = np.zeros((n + len(children), n_terms), np.int32)
        self.m = np.zeros(n + len(children), np.int64)
        self.m[:n] = m[self.order]
        sizes = np.fromiter(map(len, paths), np.int64, n)
        self.tf[np.repeat(np.arange(n), sizes), np.concatenate(paths)] = np.concatenate(counts)
        self.last = np.cumsum([0] * n + [len(c) for c in children])
        self.first = np.append(0, self.last[:-1])
        self.child = np.array([x for c in children for x in c], np.int64)
        for i, own in enumerate(children, n):
            np.max(self.tf[own], axis=0, out=self.tf[i])
            self.m[i] = self.m[own].min()
        self.leaves = n

    def scores(self, nodes: np.ndarray, own: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of documents; of other nodes the most that a document below can have."""
        tf = self.tf[nodes[:, None], own[None, :]].astype(np.int64)
        return (weights * (SCALE * tf // (1000 * tf + 20 * self.m[nodes][:, None]))).sum(axis=1)

    def search(self, own: np.ndarray, weights: np.ndarray, k: int, floor: int, ties: np.ndarray) -> list[tuple[int, int]]:
        """(score, document) of the ``k`` best for an item's terms, with scores of ``floor`` at least.

        Depth first: the best open nodes are replaced by their children; a node whose bound is under the k-th score
        found so far holds nothing that counts. Ties go to the smaller of ``ties``.
        """
        found_s, found_d = np.zeros(0, np.int64), np.zeros(0, np.int64)
        nodes, bounds = np.array([self.root]), self.scores(np.array([self.root]), own, weights)
        while len(nodes):
            keep = bounds >= floor
            nodes, bounds = nodes[keep], bounds[keep]
            if not len(nodes):
                break
            now, nodes, bounds = nodes[-TOGETHER:], nodes[:-TOGETHER], bounds[:-TOGETHER]
            sizes = self.last[now] - self.first[now]
            at = np.repeat(self.first[now] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            below = self.child[at]
            reach = self.scores(below, own, weights)
            good = reach >= floor
            below, reach = below[good], reach[good]
            leaf = below < self.leaves
            if leaf.any():
                found_s, found_d = np.append(found_s, reach[leaf]), np.append(found_d, below[leaf])
                if len(found_s) > k:
                    best = np.lexsort((ties[self.order[found_d]], -found_s))[:k]
                    found_s, found_d = found_s[best], found_d[best]
                    floor = max(floor, int(found_s[-1]))
            rising = np.argsort(reach[~leaf], kind="stable")
            nodes = np.append(nodes, below[~leaf][rising])
            bounds = np.append(bounds, reach[~leaf][rising])
        return list(zip(found_s.tolist(), self.order[found_d].tolist()))


def _vectors(docs: DataFrame, numbers: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(key, n, terms, counts): of every document with a term, how many terms it has and those of the items among them."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("counts", T.ArrayType(T.IntegerType(), False))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, own, counts = [], [], [], []
            for i, value in enumerate(batch.column(1)):
                found = terms(value.as_py())
                if found:
                    rows.append(i)
                    sizes.append(len(found))
                    kept = sorted((numbers[t], c) for t, c in Counter(found).items() if t in numbers)
                    own.append(np.fromiter((t for t, _ in kept), np.int32, len(kept)))
                    counts.append(np.fromiter((c for _, c in kept), np.int32, len(kept)))
            ends = pa.array(np.cumsum([0, *map(len, own)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *x]))) for x in (own, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), *lists], [f.name for f in schema.fields])

    return in_arrow(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("_text")), count, schema)


def _blocks(items: list[tuple], most: int) -> Iterator[list[tuple[object, set[bytes]]]]:
    block, seen = [], set()
    for item, text in items:
        own = set(terms(text))
        if block and len(seen | own) > most:
            yield block
            block, seen = [], set()
        block.append((item, own))
        seen |= own
    if block:
        yield block


def _search_block(spark: SparkSession, docs: DataFrame, block: list[tuple[object, set[bytes]]], item_field: T.StructField,
                  k: int, key: str, text: str) -> DataFrame:
    numbers = {t: i for i, t in enumerate(sorted(set().union(*(own for _, own in block))))}
    vectors = materialise(_vectors(docs, numbers, key, text), "term-vectors")
    n_docs, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(numbers), np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[row["t"]] = row["df"]
    by_df = np.lexsort((np.arange(len(df)), -df))
    rank = np.empty(len(df), np.int64)
    rank[by_df] = np.arange(len(df))
    weights = np.array([weight(n_docs, int(df[t])) for t in by_df], np.int64)
    asked = [np.sort(rank[[numbers[t] for t in own]]) if own else np.zeros(0, np.int64) for _, own in block]
    names = pa.array([item for item, _ in block], to_arrow_type(item_field.dataType))
    most_docs = max(16, CELLS * 4 // 5 // max(1, len(df)))
    schema = T.StructType([item_field, T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType())])
    item, key_kind = item_field.name, to_arrow_type(docs.schema[key].dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in asked]

        def take(part: pa.RecordBatch) -> None:
            ids = part.column(0).to_pylist()
            lists = []
            for c in ("terms", "counts"):
                column = part.column(c)
                flat, ends = column.flatten().to_numpy(), np.append(0, np.cumsum(column.value_lengths().to_numpy()))
                lists.append([flat[a:b] for a, b in zip(ends[:-1], ends[1:])])
            paths, counts = [], []
            for t, c in zip(*lists):
                path = rank[t]
                order = np.argsort(path)
                paths.append(path[order])
                counts.append(c[order])
            n = part.column("n").to_numpy().astype(object)
            m = np.array([50 + 50 * x * n_docs // total for x in n], np.int64)
            ties = np.empty(len(ids), np.int64)
            ties[sorted(range(len(ids)), key=lambda i: _late(ids[i]))] = np.arange(len(ids))
            tree = Tree(paths, counts, m, len(df))
            for i, own in enumerate(asked):
                if len(own):
                    low = best[i][-1][0] if len(best[i]) >= k else 1
                    found = [(-s, _late(ids[d]), ids[d]) for s, d in tree.search(own, weights[own], k, low, ties)]
                    if found:
                        kept = sorted([(-s, o, d) for s, o, d in best[i]] + found, key=lambda x: x[:2])[:k]
                        best[i] = [(-s, o, d) for s, o, d in kept]

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, most_docs):
                part = batch.slice(at, most_docs)
                if part.num_rows + sum(h.num_rows for h in held) > most_docs:
                    take(_one(held))
                    held = []
                held.append(part)
        if held:
            take(_one(held))
        rows = [(i, d, s) for i, own in enumerate(best) for s, _, d in own]
        at, ids, scores = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(at, pa.int64())), pa.array(ids, key_kind), pa.array(scores, pa.int64())], [item, key, "score"])

    return in_arrow(vectors.filter(F.size("terms") > 0), search, schema)


def _late(value) -> tuple:
    """Orders ids with null last."""
    return (value is None, value if value is not None else 0)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, key, score): for every item the ``k`` documents with the highest scores above 0.

    N counts the documents with a term, L their terms, n a document's, df the documents that hold a term. A term weighs
    floor(1000 * ln((2N + 2) / (2 df + 1))), a document's m is 50 + (50 n N) div L, and a score sums weight *
    (10**9 tf div (1000 tf + 20 m)) over the item's different terms. Ties go to smaller keys, null last.

    The items are the stated query set: they come to the driver and are searched in blocks of at most ``BLOCK_TERMS``
    different terms (or one item). For each block every whole document is reduced to its vector over the block's terms;
    tasks build trees of as many documents as ``CELLS`` allows and pass on ``k`` rows an item. Statistics cover all
    documents. Null and empty texts, of documents or items, have no terms: they neither count nor are found. Repeated
    documents are found each; repeated items are ranked once if they are alike, and an item id with several texts is
    asked with all their terms. Items with a null id count as one such item. Other columns are ignored.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item}`").alias("i"), F.col(f"`{item_text}`").alias("t")).filter(F.length("t") > 0)
    asked = asked.groupBy("i").agg(F.array_join(F.array_sort(F.collect_set("t")), " ").alias("t")).collect()
    asked = sorted(((r["i"], r["t"]) for r in asked), key=lambda r: _late(r[0]))
    field = T.StructField(item, items.schema[item].dataType)
    found = None
    for block in _blocks(asked, BLOCK_TERMS):
        part = _search_block(spark, docs, block, field, k, key, text)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], T.StructType([
            field, T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType())]))
    order = Window.partitionBy(item).orderBy(F.col("score").desc(), F.col(key).asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(item, "rank", key, "score")
