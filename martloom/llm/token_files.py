"""Token ids of whole texts in searchable binary files: shards of a wavelet matrix each."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.shipping import in_arrow
from martloom.llm.token_counts import slices
from martloom.llm.token_ids import encode
from martloom.llm.wavelet import Wavelet, build
from martloom.session import scratch_path

END = 2
#: Ids after which a shard is closed, and rows of a range of keys, about.
SHARD, RANGE_ROWS = 1 << 21, 100_000


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int = END, shard: int = SHARD,
                      key: str = "doc_id", text: str = "text") -> None:
    """Writes the token ids of every whole text, an end id after each, in order of the key.

    Format: Parquet files whose rows are shards, so writers on lost executors leave no trace and any file system will do.
    ``part`` and ``shard`` (in the part) order the shards; ``n_tokens`` is their size; ``keys`` and ``sizes`` list their
    documents; ``matrix`` is the image that ``wavelet.Wavelet`` reads. A shard is closed when it holds ``shard`` ids. A
    document lies in one shard; a longer one has a shard to itself.

    Null keys come first. Null and empty texts are the end id alone. Rows that share a key stand in order of their
    text's hash; rows alike in both are all written. Other columns are ignored. An empty table writes no shard.
    """
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    ranges = max(1, rows.count() // RANGE_ROWS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["k", F.xxhash64("t"), "row"]
    # Rows alike in key and text could not be told apart by a range; their place in the input parts them.
    ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order)
    ranged = ranged.sortWithinPartitions(*order).select("k", "t", F.spark_partition_id().alias("part"))
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("matrix", T.BinaryType())])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, keys, sizes, ids, held = 0, 0, [], [], [], 0

        def closed() -> pa.RecordBatch:
            n = np.concatenate(sizes)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), x)
                     for x in (pa.concat_arrays(keys), pa.array(n))]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], pa.int64()), *lists,
                 pa.array([build(np.concatenate(ids))], pa.binary())], [f.name for f in schema.fields])

        for batch in batches:
            texts = batch.column("t").to_pylist()
            for a, b in slices(texts):
                part = batch.column("part")[a].as_py()
                found, counts = encode(texts[a:b], tokenizer)
                ends = np.cumsum(counts)
                found = np.insert(found, ends, end).astype(np.uint32)
                ends += np.arange(1, len(ends) + 1)
                at = done = 0
                while at < b - a:
                    upto = min(b - a, int(np.searchsorted(ends, done + shard - held)) + 1)
                    keys.append(batch.column("k").slice(a + at, upto - at))
                    sizes.append(counts[at:upto] + 1)
                    ids.append(found[done:ends[upto - 1]])
                    held += len(ids[-1])
                    at, done = upto, int(ends[upto - 1])
                    if held >= shard:
                        yield closed()
                        number, keys, sizes, ids, held = number + 1, [], [], [], 0
        if held:
            yield closed()

    in_arrow(ranged, shards, schema, keeps=True).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document from files of ``write_token_files``: the key, start, n_tokens, ids_crc32 (and ids).

    ``start`` counts the ids of all documents before. It is summed up over the parts, of which there is one row each, then
    over the shards of a part and in a shard.
    """
    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = lambda *by: Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before("part")), F.lit(0)).alias("first"))
    inside = before("shard").partitionBy("part")
    starts = files.select("part", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("upto"))
    starts = starts.join(parts, "part").select("part", "shard", (F.col("first") + F.col("upto")).alias("start"))
    kind = files.schema["keys"].dataType.elementType
    ids_type = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
                           T.StructField("key", kind), T.StructField("at", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                           *([T.StructField("ids", ids_type)] if with_ids else [])])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = Wavelet(batch.column("matrix")[i].as_buffer()).decode().astype("<u4")
                sizes = batch.column("sizes")[i].values.to_numpy()
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[e - n:e].data) for e, n in zip(ends.tolist(), sizes.tolist())]
                own = [pa.array(np.full(len(sizes), batch.column(c)[i].as_py(), np.int32)) for c in ("part", "shard")]
                columns = [*own, batch.column("keys")[i].values, pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())]
                if with_ids:
                    bounds = pa.array(np.append(0, ends), pa.int32())
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    read = in_arrow(files.select("part", "shard", "keys", "sizes", "matrix"), documents, schema)
    placed = read.join(starts, ["part", "shard"])
    return placed.select(F.col("key").alias(key), (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
                         *(["ids"] if with_ids else []))


def token_occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Places of an id among all ids of the files, one row each, found by select in every shard.

    Columns: part, shard, place (in the shard). Nothing but the planes that the id's code passes is looked at.
    """
    schema = "part int, shard int, place long"

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = Wavelet(batch.column("matrix")[i].as_buffer()).places(token)
                own = [pa.array(np.full(len(at), batch.column(c)[i].as_py(), np.int32)) for c in ("part", "shard")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(at)], ["part", "shard", "place"])

    return in_arrow(spark.read.parquet(path).select("part", "shard", "matrix"), places, schema)


def stored_tokens(docs: DataFrame, tokenizer: str, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes token files to the session's shared folder and reads them back; one row per document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end, key=key, text=text)
    return read_token_files(spark, path, key)
