"""Packing documents into token sequences by minimum bin slack."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.ranks import ranked
from martloom.llm.shipping import in_arrow
from martloom.llm.token_counts import slices
from martloom.llm.token_ids import encode
from martloom.session import materialise

CAPACITY, END = 4096, 1
#: Long pieces that are tried to close a bin.
TRIES = 8


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every whole text with an end id, cut where they pass the capacity: one row per piece.

    Columns: the key, piece, start, length, ids_crc32, and ids if asked for. Null and empty texts give the end id alone.
    Repeated rows and null keys stay rows of their own; further columns are ignored.
    """
    fields = [T.StructField(key, docs.schema[key].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                ids, counts = encode(texts[a:b], tokenizer)
                at = np.cumsum(counts)
                rows, piece, start, length, crc, own = [], [], [], [], [], []
                for i, (hi, n) in enumerate(zip(at.tolist(), counts.tolist())):
                    whole = np.append(ids[hi - n:hi], np.uint32(end)).astype("<u4")
                    for k, lo in enumerate(range(0, n + 1, capacity)):
                        part = whole[lo:lo + capacity]
                        rows.append(a + i)
                        piece.append(k)
                        start.append(lo)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            own.append(part.astype(np.int32))
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array(own, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return in_arrow(docs.select(F.col(key), F.col(text).alias("_text")), cut, T.StructType(fields), keeps=True)


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The combination of the available lengths (falling) whose sum comes nearest to ``room`` from below.

    Bit s of a number says that some combination sums to s; a length with n copies shifts it by 1, 2, 4, ... copies.
    """
    full, mask, reach, steps = 1 << room, (2 << room) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << length * take) & mask
            left -= take
            take *= 2
        if reach & full:
            break
    found: dict[int, int] = {}
    total = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            found[length] = found.get(length, 0) + take
    return found


def closed(counts: dict[int, int], lengths: list[int], room: int, tries: int = TRIES) -> dict[int, int]:
    """The fullest combination, with a long piece in it if that leaves none emptier.

    The longest pieces that fit are tried in turn, each closed by the fullest combination of the rest; if none of the
    first few fills the room, the fullest combination of all is taken.
    """
    fit = [n for n in lengths[bisect.bisect_left(lengths, -room, key=lambda n: -n):] if counts[n]]
    for n in fit[:tries]:
        counts[n] -= 1
        found = fullest(counts, fit, room - n)
        counts[n] += 1
        if n + sum(length * k for length, k in found.items()) == room:
            found[n] = found.get(n, 0) + 1
            return found
    return fullest(counts, fit, room)


def bin_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Bins as (copies, pieces by length). The longest piece left opens a bin and the fullest combination closes it.

    Pieces of one length are alike, so a bin is repeated while its pieces last. The work depends on the number of
    different lengths, which the capacity bounds, and not on the number of pieces.
    """
    counts = {n: c for n, c in histogram.items() if c}
    lengths = sorted(counts, reverse=True)
    plan = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        found = closed(counts, lengths, capacity - longest)
        counts[longest] += 1
        found[longest] = found.get(longest, 0) + 1
        copies = min(counts[n] // k for n, k in found.items())
        plan.append((copies, found))
        for n, k in found.items():
            counts[n] -= copies * k
        lengths = [n for n in lengths if counts[n]]
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Adds ``sequence_id`` and a gapless ``offset`` to pieces whose lengths are 1 to the capacity.

    Only the number of pieces of each length, at most ``capacity`` numbers, comes to the driver; the plan of bins made
    from it is as bounded. Each piece then finds its place by its rank among the pieces of its length. Lengths that are
    null or outside 1 to the capacity are refused. Ties are told apart by all other columns; repeated rows each get a
    place. ``pieces`` is read more than once, so it should be a written table.
    """
    histogram = {}
    for row in pieces.groupBy(length).count().filter(F.col(length).between(1, capacity)).collect():
        histogram[int(row[0])] = row[1]
    bad = pieces.filter(F.col(length).isNull() | ~F.col(length).between(1, capacity)).limit(1).collect()
    if bad:
        raise ValueError(f"lengths must be 1 to {capacity}: {bad[0]}")
    plan = bin_plan(histogram, capacity)
    rank, sequence = dict.fromkeys(histogram, 0), 0
    table = []
    for copies, bin_ in plan:
        place = 0
        for n in sorted(bin_, reverse=True):
            table.append((n, rank[n], bin_[n], sequence, place))
            place += n * bin_[n]
            rank[n] += copies * bin_[n]
        sequence += copies
    table.sort()
    of_length, first, each, base, place = (np.array(c, np.int64) for c in zip(*table)) if table else [np.zeros(0, np.int64)] * 5
    lows = {int(n): (int(a), int(b)) for n, a, b in zip(
        *(lambda u: (u, np.searchsorted(of_length, u), np.searchsorted(of_length, u, "right")))(np.unique(of_length)))}
    numbered = ranked(pieces, [length], list(pieces.columns), sum(histogram.values()), "_rank")
    names = list(pieces.columns)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(length).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            sequences, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                a, b = lows[int(n)]
                row = a + np.searchsorted(first[a:b], ranks[at], "right") - 1
                within = ranks[at] - first[row]
                sequences[at] = base[row] + within // each[row]
                offsets[at] = place[row] + within % each[row] * n
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequences), pa.array(offsets)],
                                             [*names, "sequence_id", "offset"])

    return in_arrow(numbered.select(*names, "_rank"), put, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
                   with_ids: bool = False) -> DataFrame:
    """Tokenizes, cuts and packs all documents; one row per piece."""
    return pack(materialise(token_pieces(docs, tokenizer, capacity, end, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with ids: sequence_id, n_tokens, ids, and doc_ids with their offsets.

    A sequence holds at most ``capacity`` tokens, so no group grows with the data.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
                    F.col("p.offset").alias("offsets"))
            .withColumn("n_tokens", F.size("ids").cast("long")))
