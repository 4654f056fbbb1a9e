"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.names import back, marks, one_of_alike
from martloom.llm.ranks import ranked
from martloom.session import materialise

WEIGHTS, MOST_COPIES = (5, 2, 1), 3
#: Characters that part words; a word is a run of others.
BLANKS = "\\x20\\x09-\\x0D"
#: Parts of the unit that a random offset is taken from.
OFFSETS = 1 << 20
#: Copies of rows alike that are written side by side.
TOGETHER = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: its size, and the share of all sizes it is to have.

    Sources take the weights in turn, by code point, null last. A target stops at ``most`` times its source's size and
    the excess goes to the others by weight, until none is above: with sources ordered by size per weight, a first
    stretch is full and the rest share one factor. There is one row per source here, not per document.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("double"))
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    share = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("_share", share).withColumn("_open", F.col("_share") * F.col("weight") <= most * F.col("source_size"))
    factor = F.first(F.when(F.col("_open"), F.col("_share")), ignorenulls=True).over(everything)
    per = per.withColumn("_factor", factor)
    full = F.coalesce(F.col("_factor") * F.col("weight") > most * F.col("source_size"), F.lit(True))
    target = F.when(full, (most * F.col("source_size")).cast("double")).otherwise(F.col("_factor") * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = "mix",
        key: str = "doc_id") -> DataFrame:
    """For every document the key, source, size, source_size, target (its source's) and copies (0 to ``most``).

    A document's expected copies are its source's target by its size. Documents of a source stand in order of size, so
    that the words taken come near the target too; their expected copies are summed up in that order, a random offset
    from the seed and the source is added, and each integer passed is one copy. Null sources are one source; null and
    empty texts have size 0; repeated rows are documents of their own; reruns agree. Other columns are ignored here.
    """
    sized = materialise(docs.select(key, "source", word_count(F.col("text")).alias("size"), *marks(docs)), "sized")
    targets = source_targets(sized, weights, most)
    cells = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("band", F.shiftright("size", 8))
    in_band = Window.partitionBy("source", "band").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    over_bands = Window.partitionBy("source").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = cells.groupBy("source", "band").agg(F.sum("n").alias("n"))
    bands = bands.select("source", "band", F.coalesce(F.sum("n").over(over_bands), F.lit(0)).alias("b"))
    cells = cells.select("source", "band", "size", F.coalesce(F.sum("n").over(in_band), F.lit(0)).alias("c"))
    cells = _joined(cells, bands, ["source", "band"], ["source", "size", (F.col("b") + F.col("c")).alias("before")])
    cells = _joined(cells, targets, ["source"], ["source", "size", "before", "source_size", "target"])
    placed = ranked(sized, ["source", "size"], [key, "_a", "_b"], sized.count())
    keep = [key, "source", "size", "source_size", "target", "_a", "_b"]
    placed = _joined(placed, cells, ["source", "size"], [*keep, (F.col("before") + F.col("rank")).alias("_i")])
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), name)), 1, 5), 16, 10).cast("double") / OFFSETS
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    passed = F.floor((F.col("_i") + 1) * each + offset) - F.floor(F.col("_i") * each + offset)
    return placed.select(*keep, F.least(passed, F.lit(most)).cast("int").alias("copies"))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], columns: list) -> DataFrame:
    """An inner join in which null equals null; the keys are the left ones."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(other[f"_{k}"])
    return left.join(other, on).select(*columns)


def mixed(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as its copies, with the columns of ``docs``, whatever their names.

    Rows alike in every column stand for each other: one of them is kept by each task, and takes the copies of all, in
    blocks of ``TOGETHER``, so that neither the rows nor the copies of a large group meet in one cell.
    """
    wanted = plan.groupBy("_a", "_b").agg(F.sum("copies").alias("_n")).filter(F.col("_n") > 0)
    steps = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / TOGETHER))
    blocks = wanted.select("_a", "_b", "_n", F.explode(steps).alias("_block"))
    times = F.least(F.lit(TOGETHER).cast("long"), F.col("_n") - F.col("_block") * TOGETHER)
    found = one_of_alike(docs).join(blocks, ["_a", "_b"])
    found = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("_time"))
    return found.select(*back(docs))
