"""Token-id output: documents in id order as chunks of shuffled planes, with a chunk index.

A store is a folder of three parts, all written by Spark's committing writer, so that a lost
executor leaves no half-written file and any Hadoop file system will do:

* `chunks/`: one row per chunk: shard, chunk, the doc_ids and their token counts, and `planes`.
* `index/`: one row per chunk: shard, chunk, start (ids before it in the whole store), n_tokens,
  n_docs, first and last doc_id, crc32 of the ids. It is enough to find a document or a position.
* ids of a chunk are cut in blocks of a fixed size; each block is transposed into byte planes
  (or bit planes), equal planes of the blocks are joined, and each joined plane is a zstandard frame.

A chunk closes at the first document end at or after `chunk_tokens` ids. Documents are dealt to shards by
ranges of doc_id, so only text crosses the shuffle, once, and the order needs no single task.

Null texts count as empty, empty texts are the end id alone, a null doc_id sorts first, repeated
rows are all kept (ordered by text), an empty table gives an empty store, other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import bounded_batches, record_batch, size_sliced, text_or_empty
from .tokens import shared_encoder

CHUNK_TOKENS = 1 << 16
BLOCK = 4096

_CHUNKS = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("crc32", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("planes", pa.binary()),
])


def _blocks(n: int, block: int) -> int:
    return -(-n // block) * block


def shuffle_planes(ids: np.ndarray, block: int = BLOCK, bits: bool = False) -> bytes:
    """Planes of the ids: a header of three uint32 (count, block, bits) and per plane a length and a frame."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = len(ids)
    padded = np.zeros(_blocks(n, block), "<u4")
    padded[:n] = ids
    cells = padded.view("u1").reshape(-1, block, 4)
    if bits:
        flags = np.unpackbits(cells, axis=2, bitorder="little")
        planes = np.packbits(flags.transpose(2, 0, 1), axis=2, bitorder="little")
    else:
        planes = cells.transpose(2, 0, 1)
    packer = zstandard.ZstdCompressor(level=1)
    out = [np.array([n, block, bits], "<u4").tobytes()]
    for plane in planes:
        frame = packer.compress(np.ascontiguousarray(plane).tobytes()) if plane.any() else b""
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def restore_planes(raw: bytes) -> np.ndarray:
    n, block, bits = np.frombuffer(raw, "<u4", 3).tolist()
    rows, at, opener = _blocks(n, block) // block, 12, zstandard.ZstdDecompressor()
    width = block // 8 if bits else block
    planes = np.zeros((32 if bits else 4, rows, width), "u1")
    for plane in planes:
        size = int.from_bytes(raw[at : at + 4], "little")
        if size:
            plane[:] = np.frombuffer(opener.decompress(raw[at + 4 : at + 4 + size]), "u1").reshape(rows, width)
        at += 4 + size
    if bits:
        flags = np.unpackbits(planes, axis=2, bitorder="little").transpose(1, 2, 0)
        cells = np.packbits(flags, axis=2, bitorder="little")
    else:
        cells = planes.transpose(1, 2, 0)
    return np.ascontiguousarray(cells).reshape(-1).view("<u4")[:n]


def _encode_chunks(tokenizer: str | None, end_id: int, chunk_tokens: int, block: int, bits: bool):
    def encode(batches):
        from pyspark import TaskContext

        shard, encoder, end = TaskContext.get().partitionId(), shared_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        chunk, ids, doc_ids, lengths, held = 0, [], [], [], 0

        def closed():
            raw = b"".join(ids)
            return record_batch(_CHUNKS, {
                "shard": [shard], "chunk": [chunk], "n_tokens": [held], "n_docs": [len(lengths)], "crc32": [zlib.crc32(raw)],
                "doc_ids": [doc_ids], "lengths": [lengths], "planes": [shuffle_planes(np.frombuffer(raw, "<u4"), block, bits)],
            })

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in size_sliced(texts):
                for key, raw in zip(keys[a:b], encoder.encode(texts[a:b]), strict=True):
                    ids += [raw, end]
                    doc_ids.append(key)
                    lengths.append(len(raw) // 4 + 1)
                    held += lengths[-1]
                    if held >= chunk_tokens:
                        yield closed()
                        chunk, ids, doc_ids, lengths, held = chunk + 1, [], [], [], 0
        if lengths:
            yield closed()

    return encode


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = 0, chunk_tokens: int = CHUNK_TOKENS, block: int = BLOCK, bit_planes: bool = False) -> str:
    """Encode every text, append `end_id` to each, and write the store at `path`."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    chunks = ordered.mapInArrow(_encode_chunks(tokenizer, end_id, chunk_tokens, block, bit_planes), from_arrow_schema(_CHUNKS))
    chunks.write.parquet(f"{path}/chunks")
    _index(_read_chunks(spark, path)).write.parquet(f"{path}/index")
    return path


def _read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(from_arrow_schema(_CHUNKS)).parquet(f"{path}/chunks")


def _index(chunks: DataFrame) -> DataFrame:
    """Start of each chunk: a running sum inside its shard, and one over the few shard totals."""
    heads = chunks.select("shard", "chunk", "n_tokens", "n_docs", F.element_at("doc_ids", 1).alias("first_doc_id"), F.element_at("doc_ids", -1).alias("last_doc_id"), "crc32")
    shards = heads.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = shards.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n_tokens")
    return heads.withColumn("inside", inside).join(before, "shard").select("shard", "chunk", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "n_docs", "first_doc_id", "last_doc_id", "crc32")


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
_DOCS_IDS = _DOCS.append(pa.field("ids", pa.list_(pa.int32())))


def _decode_chunks(with_ids: bool):
    schema = _DOCS_IDS if with_ids else _DOCS

    def decode(batches):
        for batch in batches:
            starts, doc_ids, lengths, planes = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                ids, sizes = restore_planes(planes[i].as_py()), np.array(lengths[i].as_py(), "i8")
                ends = np.cumsum(sizes)
                raw, begins = memoryview(ids.tobytes()), ends - sizes
                out = {
                    "doc_id": doc_ids[i].as_py(), "start": begins + starts[i].as_py(), "n_tokens": sizes,
                    "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)],
                }
                if with_ids:
                    out["ids"] = [ids[a:b].astype("i4") for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield record_batch(schema, out)

    return decode


def read_tokens(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """One row per document from the store: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""
    bounded_batches(spark)
    index = spark.read.parquet(f"{path}/index").select("shard", "chunk", "start")
    rows = _read_chunks(spark, path).select("shard", "chunk", "doc_ids", "lengths", "planes").join(index, ["shard", "chunk"])
    return rows.select("start", "doc_ids", "lengths", "planes").mapInArrow(_decode_chunks(with_ids), from_arrow_schema(_DOCS_IDS if with_ids else _DOCS))
