"""Exact top-k inner products by three-phase uniform threshold."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shipping import ship
from martloom.session import materialise

SCALE, LISTS = 64, 4
#: Queries and candidates of a block; blocks of candidates at least; candidates of a tile within a task.
QUERIES, CANDIDATES, LEAST_BLOCKS, TILE = 1024, 16384, 64, 2048


def usable(key: str, vector: str) -> Column:
    """Rows that take part: with an id and a vector whose components are all finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(key).isNotNull() & F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(vectors: pd.Series, scale: int) -> np.ndarray:
    """Whole numbers floor(scale * x); shorter vectors end in zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.floor(scale * np.asarray(v, np.float64))
    return out


def _tiles(left: pd.DataFrame, right: pd.DataFrame, scale: int, lists: int):
    """(candidate ids, partial scores of each list, own pairs) for tiles of candidates, in order of id.

    A list is a stretch of the components; its scores are the inner products over that stretch. Scores are whole numbers
    in doubles, exact up to 2**53; vectors so large that they could pass that are counted with Python's whole numbers.
    """
    right = right.sort_values("cid", kind="stable")
    a, b = _matrix(left["v"], scale), _matrix(right["cv"], scale)
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) >= 2.0 ** 53:
        a, b = (np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) for x in (a, b))
    ids, own = right["cid"].to_numpy(), left["id"].to_numpy()
    cuts = np.linspace(0, width, lists + 1).astype(int)
    for lo in range(0, len(ids), TILE):
        part = slice(lo, lo + TILE)
        yield ids[part], [a[:, s:e] @ b[part, s:e].T for s, e in zip(cuts, cuts[1:])], own[:, None] == ids[part][None, :]


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of every row number, ties to smaller ids."""
    order = np.lexsort((ids, -scores, rows)) if scores.dtype != object else np.array(
        sorted(range(len(rows)), key=lambda i: (rows[i], -scores[i], ids[i])), np.int64)
    sorted_rows = rows[order]
    nth = np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows)
    return order[nth < k]


def top_k(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
          scale: int = SCALE, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, key, score): the k highest scores of every query among all rows with another id.

    The score is the inner product of the vectors' components as floor(scale * x). Ties go to smaller ids. Vectors null or
    with null, not-a-number or infinite components, and rows without an id, take no part; vectors may differ in length
    (missing components count 0); repeated rows are candidates each, and a repeated query's rows give one list, that of its
    least vector.

    Vectors meet in blocks; candidates are dealt to them by row, so rows that share an id are spread. 1: each block gathers, list by list, the local best of every query, and passes on the totals
    of a few. The k-th highest of all these is a safe cutoff. 2: an entry whose scores all lie below cutoff / lists
    cannot reach it; the others of every list are collected. 3: those are resolved exactly, and what reaches the cutoff,
    at most k of a block, is passed on.
    """
    ship(vectors.sparkSession)
    base = materialise(vectors.filter(usable(key, vector)).select(
        F.col(key).alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")), "vectors")
    n, n_queries = base.agg(F.count(F.lit(1)), F.count_if("q")).first()
    q_blocks, c_blocks = max(1, -(-n_queries // QUERIES)), max(LEAST_BLOCKS, -(-n // CANDIDATES))
    few = min(k, -(-2 * k // c_blocks) + 1)
    kind = vectors.schema[key].dataType.simpleString()
    block = lambda m, *of: F.pmod(F.xxhash64(*of), F.lit(m)).cast("int")
    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = base.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    queries = materialise(queries.select("id", "v", block(q_blocks, "id").alias("qb")), "queries")
    candidates = base.select(F.col("id").alias("cid"), F.col("v").alias("cv"), block(c_blocks, F.monotonically_increasing_id()).alias("cb"),
                             numbers(q_blocks).alias("qb"))

    def gather(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            for ids, partial, own in _tiles(left, right, scale, lists):
                total = sum(partial)
                chosen = np.zeros(own.shape, bool)
                top = min(few, len(ids))
                for p in partial:
                    p = np.where(own, -np.inf, p.astype(float))
                    at = np.argpartition(-p, top - 1, axis=1)[:, :top]
                    np.put_along_axis(chosen, at, True, 1)
                rows, cols = np.nonzero(chosen & ~own)
                found.append((rows, ids[cols], total[rows, cols]))
        return _rows(left, found, few)

    def _rows(left: pd.DataFrame, found: list, most: int) -> pd.DataFrame:
        if not found:
            return pd.DataFrame({"query_id": [], key: [], "score": []})
        rows, ids, scores = (np.concatenate(x) for x in zip(*found))
        keep = _best(rows, ids, scores, most)
        return pd.DataFrame({"query_id": left["id"].to_numpy()[rows[keep]], key: ids[keep],
                             "score": [int(s) for s in scores[keep]]})

    def resolve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            # Cutoffs come as text: a column of long numbers with nulls would reach pandas as doubles.
            exact = np.array([-np.inf if c is None else int(c) for c in left["cutoff"]], object)
            for ids, partial, own in _tiles(left, right, scale, lists):
                # Scores in doubles are below 2**53; a cutoff that a double cannot hold is above them all.
                low = (exact if partial[0].dtype == object else exact.astype(float))[:, None]
                some = np.zeros(own.shape, bool)
                for p in partial:
                    some |= (p * lists >= low).astype(bool)
                rows, cols = np.nonzero(some & ~own)
                total = sum(partial)[rows, cols]
                reach = (total >= low[rows, 0]).astype(bool)
                found.append((rows[reach], ids[cols[reach]], total[reach]))
        return _rows(left, found, k)

    schema = f"query_id {kind}, {key} {kind}, score long"
    asked = queries.select("id", "v", "qb", numbers(c_blocks).alias("cb"))
    first = asked.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb")).applyInPandas(gather, schema)
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(key))
    cutoffs = (first.select("query_id", key, "score", F.row_number().over(by_query).alias("rank"))
               .filter(F.col("rank") == k).select("query_id", F.col("score").cast("string").alias("cutoff")))
    cutoffs = materialise(cutoffs, "cutoffs")
    told = queries.join(cutoffs.withColumnRenamed("query_id", "id"), "id", "left").select("id", "v", "cutoff", "qb")
    told = told.select("*", numbers(c_blocks).alias("cb"))
    last = told.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb")).applyInPandas(resolve, schema)
    ranked = last.select("query_id", F.row_number().over(by_query).alias("rank"), key, "score")
    return ranked.filter(F.col("rank") <= k)
