"""Problem 6: token ids of every text.

Defined results: one row for each input row, repeated ones too; a null and an empty text have the empty list; blank
texts are encoded like any other; the texts of special tokens are ordinary text. Texts of any length are encoded whole.
Only the id and the text column are read.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.llm import bpe
from leasemill.session import ship_package

#: A row's number has its task above these bits.
TASK_BITS = 40


def prepare(df: DataFrame) -> None:
    """Gives the workers this package. Spark bounds an Arrow batch by its bytes (64 MB unless the session says otherwise), so
    that batches of long texts fit a worker; a longer text makes a batch of its own."""
    ship_package(df.sparkSession)


def broadcast_file(df: DataFrame, path: str | None):
    """The vocabulary file to all workers; its size is checked when it is read."""
    return df.sparkSession.sparkContext.broadcast(bpe.read_file(path))


def own_name(name: str, *taken: str) -> str:
    """The name of a key column; one that the result has itself is refused."""
    if name in taken:
        raise ValueError(f"a key may not be named {name}")
    return name


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """The key and ``ids`` (array of int). No shuffle."""
    prepare(df)
    file = broadcast_file(df, path)
    source = df.select(F.col(own_name(key, "ids", "_text_")), F.col(text).cast("string").alias("_text_"))
    out = T.StructType([source.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        tokenizer = bpe.load(file.value)
        for b in batches:
            ids, offsets = tokenizer.encode_all(b.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=out.names)

    return source.mapInArrow(run, out)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """The key and ``text``: the inverse of :func:`encode`, for ids of whole texts. Null ids give a null text; bytes that
    are no UTF-8, which only ids of parts of a text can give, become U+FFFD."""
    prepare(df)
    file = broadcast_file(df, path)
    source = df.select(F.col(own_name(key, "text", "_ids_")), F.col(ids).alias("_ids_"))
    out = T.StructType([source.schema[key], T.StructField("text", T.StringType())])

    def run(batches):
        tokenizer = bpe.load(file.value)
        for b in batches:
            lists = b.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            offsets = [0, *sizes.cumsum().tolist()]
            data, ends = tokenizer.decode_all(flat, offsets)
            raw = data.tobytes()
            valid = lists.is_valid().to_pylist()
            texts = [raw[a:z].decode("utf-8", "replace") if ok else None for a, z, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), valid)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=out.names)

    return source.mapInArrow(run, out)


def token_counts(df: DataFrame, keys: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """The key columns, ``n_tokens``, and ``_at``, a number of the row that no other row has: its task and its place there."""
    prepare(df)
    file = broadcast_file(df, path)
    source = df.select(F.col(text).cast("string").alias("_text_"), *keys)
    out = T.StructType([*source.schema.fields[1:], T.StructField("n_tokens", T.LongType()), T.StructField("_at", T.LongType())])

    def run(batches):
        tokenizer = bpe.load(file.value)
        at = TaskContext.get().partitionId() << TASK_BITS
        for b in batches:
            counts = tokenizer.count_all(b.column(0).to_pylist())
            places = pa.array(range(at, at + b.num_rows), pa.int64())
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(counts, pa.int64()), places], names=out.names)

    return source.mapInArrow(run, out)
