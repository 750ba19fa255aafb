"""Operator 1: token ids in bit-plane shuffled, compressed blocks of fixed size.

Format. A data set is a Parquet folder of shards. A row is one block of ``block_ids`` ids (the
last of a shard may be shorter): its ids are transposed into planes (plane ``p`` holds byte ``p``
or bit ``p`` of every id), and each plane is compressed by zstandard. High planes of small ids
are constant and shrink to a few bytes. The chunk index, a second folder, has for each block its
place in the whole stream, the sizes of its planes and the documents that start in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import parts
from tidemark.llm.tokens import encoder, local_path
from tidemark.session import new_path

BLOCK_IDS = 1 << 16
LEVEL = 3
_SCHEMA = (
    "shard int, block long, first long, n_ids int, planes array<binary>, head_id long, head_first long, "
    "head_length long, doc_ids array<long>, doc_firsts array<long>, doc_lengths array<long>"
)


@dataclass(frozen=True)
class TokenFiles:
    """The two folders of a written data set."""

    blocks: str
    index: str


def shuffle_planes(ids: np.ndarray, planes: str = "byte") -> list[bytes]:
    """The byte or bit planes of 32-bit ids, lowest first, each compressed."""
    pack = zstandard.ZstdCompressor(level=LEVEL)
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [pack.compress(raw[:, p].tobytes()) for p in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [pack.compress(np.packbits(bits[:, p], bitorder="little").tobytes()) for p in range(32)]


def unshuffle_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of ``n`` entries in 4 byte planes or 32 bit planes."""
    unpack = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(unpack.decompress(p), np.uint8) for p in planes]
    if len(rows) == 32:
        bits = np.stack([np.unpackbits(r, count=n, bitorder="little") for r in rows], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    else:
        raw = np.stack(rows, axis=1)
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class _Blocks:
    """Cuts the stream of one shard into blocks."""

    def __init__(self, shard: int, block_ids: int, planes: str) -> None:
        self.shard, self.block_ids, self.planes = shard, block_ids, planes
        self.pending: list[bytes] = []
        self.held = self.block = self.first = 0
        self.docs: list[tuple[int, int, int]] = []
        self.head: tuple[int, int, int] | None = None

    def add(self, doc_id: int, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id, self.first + self.held, n))
        self.pending.append(ids)
        self.held += n

    def take(self, last: bool = False) -> Iterator[dict]:
        if self.held < self.block_ids and not (last and self.held):
            return
        ids = np.frombuffer(b"".join(self.pending), "<u4")
        at = 0
        while len(ids) - at >= self.block_ids or (last and at < len(ids)):
            cut = ids[at : at + self.block_ids]
            end = self.first + len(cut)
            here = [d for d in self.docs if d[1] < end]
            head = self.head or (None, None, None)
            yield {
                "shard": self.shard, "block": self.block, "first": self.first, "n_ids": len(cut),
                "planes": shuffle_planes(cut, self.planes),
                "head_id": head[0], "head_first": head[1], "head_length": head[2],
                "doc_ids": [d[0] for d in here], "doc_firsts": [d[1] for d in here],
                "doc_lengths": [d[2] for d in here],
            }
            last_doc = here[-1] if here else self.head
            self.head = last_doc if last_doc and last_doc[1] + last_doc[2] > end else None
            self.docs = self.docs[len(here) :]
            self.block, self.first, at = self.block + 1, end, at + len(cut)
        self.pending, self.held = [ids[at:].tobytes()], len(ids) - at


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    spaces: str | None,
    end_id: int,
    block_ids: int = BLOCK_IDS,
    planes: str = "byte",
    shards: int | None = None,
) -> TokenFiles:
    """Encode ``(doc_id, text)`` and write the blocks in ascending doc_id order.

    Range partitioning by doc_id makes one shard per partition; documents move as text, once.
    A null text is empty: only the end id. Rows with equal doc_id stay apart, ordered by text;
    a null doc_id sorts first. Other columns are ignored. An empty table gives empty folders.
    """
    spark = docs.sparkSession
    target = TokenFiles(new_path(spark, "token-blocks"), new_path(spark, "token-index"))
    end = np.array([end_id], "<u4").tobytes()
    out_schema = _arrow_schema()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(local_path(tokenizer), spaces)
        blocks = _Blocks(TaskContext.get().partitionId(), block_ids, planes)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i in range(0, len(texts), 1024):
                for doc_id, ids in zip(doc_ids[i : i + 1024], ids_of.encode(texts[i : i + 1024]), strict=True):
                    blocks.add(doc_id, ids + end)
                if rows := list(blocks.take()):
                    yield pa.RecordBatch.from_pylist(rows, out_schema)
        if rows := list(blocks.take(last=True)):
            yield pa.RecordBatch.from_pylist(rows, out_schema)

    (
        docs.select("doc_id", "text")
        .repartitionByRange(shards or parts(spark), "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, _SCHEMA)
        .write.option("compression", "none")
        .parquet(target.blocks)
    )
    chunks = spark.read.schema(_SCHEMA).parquet(target.blocks)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shard_sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))  # one row per shard
    offsets = shard_sizes.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("shard_start"))
    (
        chunks.select("shard", "block", "first", "n_ids", F.transform("planes", F.length).alias("plane_bytes"), "doc_ids")
        .join(offsets, "shard")
        .select("shard", "block", "shard_start", (F.col("shard_start") + F.col("first")).alias("first"), "n_ids", "plane_bytes", "doc_ids")
        .write.parquet(target.index)
    )
    return target


def _arrow_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema(
        [
            ("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int32()),
            ("planes", pa.list_(pa.binary())), ("head_id", pa.int64()), ("head_first", pa.int64()),
            ("head_length", pa.int64()), ("doc_ids", longs), ("doc_firsts", longs), ("doc_lengths", longs),
        ]
    )


def read_token_parts(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Per document and block ``(doc_id, start, n_tokens, skip, crc, ids)``.

    ``start`` counts the ids of all documents before. A document inside one block has the crc32
    of its ids and no ``ids``; of one that crosses blocks every part has its ids as bytes, at
    ``skip`` from the document's start.
    """
    starts = spark.read.parquet(files.index).groupBy("shard").agg(F.first("shard_start").alias("shard_start"))
    blocks = spark.read.schema(_SCHEMA).parquet(files.blocks)
    schema = "doc_id long, start long, n_tokens long, skip long, crc long, ids binary"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unshuffle_planes(row["planes"], row["n_ids"])
                first, end = row["first"], row["first"] + row["n_ids"]
                docs = list(zip(row["doc_ids"], row["doc_firsts"], row["doc_lengths"], strict=True))
                if row["head_first"] is not None:
                    docs.insert(0, (row["head_id"], row["head_first"], row["head_length"]))
                out = {k: [] for k in ("doc_id", "start", "n_tokens", "skip", "crc", "ids")}
                for doc_id, at, n in docs:
                    a, b = max(at, first), min(at + n, end)
                    data = ids[a - first : b - first].astype("<u4").tobytes()
                    whole = b - a == n
                    out["doc_id"].append(doc_id)
                    out["start"].append(row["shard_start"] + at)
                    out["n_tokens"].append(n)
                    out["skip"].append(a - at)
                    out["crc"].append(zlib.crc32(data) if whole else None)
                    out["ids"].append(None if whole else data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()], list(out)
                )

    # One row per shard, and a shard is a partition of the writing job: bounded, so broadcast.
    return blocks.join(F.broadcast(starts), "shard").mapInArrow(decode, schema)


def token_digests(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files.

    Only parts of documents that cross a block carry ids through the shuffle.
    """
    part = F.when(F.col("ids").isNotNull(), F.struct("skip", "ids"))
    grouped = read_token_parts(spark, files).groupBy("doc_id", "start", "n_tokens").agg(
        F.max("crc").alias("_crc"), F.sort_array(F.collect_list(part)).alias("_parts")
    )
    joined = F.unhex(F.array_join(F.transform("_parts", lambda p: F.hex(p["ids"])), ""))
    return grouped.select("doc_id", "start", "n_tokens", F.coalesce("_crc", F.crc32(joined)).alias("ids_crc32"))
