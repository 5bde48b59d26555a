"""Token ids in Arrow stream-file (IPC file) shards.

A shard holds record batches of two fixed-size-list columns, ``input_ids``
(uint16 if the vocabulary fits, else uint32) and ``mask`` (bits, set for an id,
unset for padding), all rows of ``seq_len`` entries, so any sequence of a
memory-mapped shard is read without a copy. Documents follow each other in ascending id order, each with an end id;
the last sequence of a shard is padded. The shard's schema metadata name its
place in the order and its documents with their starts and lengths.

Shards are written by Spark's own file writer (one binary row a file), so they
go to any file system Spark can write, a lost task leaves nothing behind, and
no executor needs a local folder.
"""
from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolefeed.llm.common import checkpointed
from rolefeed.llm.encoder import encoder

ROWS = 256  # sequences of a record batch
MAGIC_END = b"1"  # an Arrow file ends in "ARROW1"; the writer's line end puts the last byte


def _shard(ids: np.ndarray, documents: list, order: tuple[int, int], seq_len: int, narrow: bool) -> bytes:
    rows = -(-len(ids) // seq_len)
    padded = np.zeros(rows * seq_len, "<u2" if narrow else "<u4")
    padded[:len(ids)] = ids
    mask = np.arange(rows * seq_len) < len(ids)
    schema = pa.schema(
        [pa.field("input_ids", pa.list_(pa.from_numpy_dtype(padded.dtype), seq_len)), pa.field("mask", pa.list_(pa.bool_(), seq_len))],
        metadata={"order": json.dumps(order), "n_tokens": str(len(ids)), "documents": json.dumps(documents)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, schema) as out:
        for at in range(0, rows, ROWS):
            part = slice(at * seq_len, (at + ROWS) * seq_len)
            out.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(padded[part]), seq_len),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask[part]), seq_len)], schema=schema))
    data = sink.getvalue().to_pybytes()
    assert data.endswith(MAGIC_END)
    return data[:-1]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, seq_len: int = 1024,
          shard_tokens: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write the shards to ``folder`` in ascending id
    order (null ids first; documents of equal id by a hash of the text). A null text is an
    empty one: its end id alone. A shard ends with the document that fills
    ``shard_tokens``; a document is never split over shards. An empty table
    writes no shard. ``tokenizer``: path of a tokenizers file on the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        end = np.array([end_id], "<u4")
        narrow = max(own.size, end_id + 1) <= 1 << 16
        context = TaskContext.get()
        place, number = context.partitionId() if context else 0, 0
        held: list[np.ndarray] = []
        documents: list = []
        n = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.record_batch({"content": pa.array([_shard(ids, documents, (place, number), seq_len, narrow)], pa.binary())})

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.many(batch.column("text"))):
                documents.append((doc_id, n, len(ids) + 1))
                held += [ids, end]
                n += len(ids) + 1
                if n >= shard_tokens:
                    yield flush()
                    held, documents, n, number = [], [], 0, number + 1
        if documents:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # a hash of the text breaks ties: keys are sampled to the driver, so they stay short
    shards = rows.orderBy("doc_id", F.xxhash64("text")).mapInArrow(run, "content binary")
    (shards.select(F.col("content").cast("string").alias("value")).write
     .option("lineSep", MAGIC_END.decode()).option("maxRecordsPerFile", 1).text(folder))


def open_shard(content: bytes) -> tuple[np.ndarray, np.ndarray, dict]:
    """ids and mask (both n x seq_len; the ids of one batch without a copy) and the metadata of a shard."""
    reader = pa.ipc.open_file(pa.BufferReader(content))
    meta = {k.decode(): json.loads(v) for k, v in reader.schema.metadata.items()}
    width = reader.schema.field("input_ids").type.list_size
    ids, mask = [], []
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        ids.append(batch.column("input_ids").flatten().to_numpy().reshape(-1, width))
        mask.append(batch.column("mask").flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
    one = lambda x: x[0] if len(x) == 1 else np.concatenate(x)
    return one(ids), one(mask), meta


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).where(F.col("length") > 0).select("content")


def read_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """``place, shard, row, input_ids, mask``: every sequence of the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                ids, mask, meta = open_shard(content.as_py())
                n = len(ids)
                yield pa.record_batch({
                    "place": pa.array([meta["order"][0]] * n, pa.int64()), "shard": pa.array([meta["order"][1]] * n, pa.int64()),
                    "row": pa.array(range(n), pa.int64()), "input_ids": pa.array(ids.tolist(), pa.list_(pa.int64())),
                    "mask": pa.array(mask.astype(np.int32).tolist(), pa.list_(pa.int32()))})

    return _shards(spark, folder).mapInArrow(
        run, "place long, shard long, row long, input_ids array<long>, mask array<int>")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the shards:
    ``start`` counts the ids of all documents before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                ids, mask, meta = open_shard(content.as_py())
                flat = np.ascontiguousarray(ids).reshape(-1)[: int(mask.sum())].astype("<u4")
                rows = [(meta["order"][0], meta["order"][1], d, at, n, zlib.crc32(flat[at:at + n].data), len(flat))
                        for d, at, n in meta["documents"]]
                names = ("place", "shard", "doc_id", "at", "n_tokens", "ids_crc32", "shard_tokens")
                yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in zip(names, zip(*rows))})

    rows = checkpointed(_shards(spark, folder).mapInArrow(
        run, "place long, shard long, doc_id long, at long, n_tokens long, ids_crc32 long, shard_tokens long"))
    # starts: over the shards of a place, then over the places; never over documents
    shards = rows.where("at = 0").groupBy("place", "shard").agg(F.max("shard_tokens").alias("n"))
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("in_place", F.coalesce(F.sum("n").over(before), F.lit(0)))
    places = shards.groupBy("place").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    places = places.select("place", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    starts = shards.join(places, "place").select("place", "shard", (F.col("base") + F.col("in_place")).alias("base"))
    return rows.join(starts, ["place", "shard"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
