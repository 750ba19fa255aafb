"""Operator 9: lines that other documents hold, found by a range sort and kept as bitmaps.

Every line becomes (hash, document, position). Rows are range-partitioned by all three, so the
rows of one very common line spread over many partitions, and sorted within. One pass over a
partition streams the first document of each hash; only the first hash of a partition may have
begun in an earlier one, so every partition also reports its edge hashes and a small join
settles those rows. The result is one compressed bitmap of kept lines per document, not text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import free_names, freeing, parts, stored

MIN_KEY_CHARS = 10
_BLANKS = b"\x09\x0a\x0b\x0c\x0d\x20"


def line_keys(text: str | None) -> list[bytes]:
    """The key of every line: stripped of blanks at both ends, A-Z in lower case."""
    return [line.strip(_BLANKS).lower() for line in (text or "").encode().split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least


def hash_lines(docs: DataFrame, least: int = MIN_KEY_CHARS) -> DataFrame:
    """``(h1, h2, doc_id, line)`` of every line whose key has at least ``least`` code points."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, ids, at = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, key in enumerate(line_keys(text)):
                    if _long_enough(key, least):
                        h.append(xxhash.xxh3_128_digest(key))
                        ids.append(doc_id)
                        at.append(i)
            both = np.frombuffer(b"".join(h), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(ids, pa.int64()), pa.array(at, pa.int32())],
                ["h1", "h2", "doc_id", "line"],
            )

    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return known.mapInArrow(freeing(rows), "h1 long, h2 long, doc_id long, line int")


def _stream_firsts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows after the first document of their hash; edge rows that only other partitions settle.

    ``kind`` 0: drop; 1: a row of the first document of the partition's leading hash, to drop if
    an earlier partition has that hash; 2: first document of the partition's trailing hash.
    """
    last: tuple[int, int] | None = None
    first_doc, leading = 0, True
    for pdf in batches:
        if pdf.empty:
            continue
        h1, h2, doc = (pdf[c].to_numpy() for c in ("h1", "h2", "doc_id"))
        new = np.ones(len(pdf), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = last == (int(h1[0]), int(h2[0]))
        new[0] = not goes_on
        group = np.cumsum(new)
        firsts = np.concatenate(([first_doc], doc[new]))
        of_group = firsts[group]
        lead_group = 1 if last is None else 0
        in_lead = (group == lead_group) & leading
        drop = doc > of_group
        kind = np.where(drop, 0, np.where(in_lead, 1, -1)).astype(np.int32)
        if (kind >= 0).any():
            yield pdf.assign(kind=kind)[kind >= 0]
        leading = leading and not (group > lead_group).any()
        last, first_doc = (int(h1[-1]), int(h2[-1])), int(of_group[-1])
    if last is not None:
        yield pd.DataFrame({"h1": [last[0]], "h2": [last[1]], "doc_id": [first_doc], "line": np.array([0], np.int32), "kind": np.array([2], np.int32)})


def repeated_lines(hashed: DataFrame) -> DataFrame:
    """``(doc_id, line)`` of every line whose key a document with a smaller id holds."""
    order = ["h1", "h2", "doc_id", "line"]
    found = stored(
        hashed.repartitionByRange(parts(hashed.sparkSession), *order)
        .sortWithinPartitions(*order)
        .mapInPandas(_stream_firsts, "h1 long, h2 long, doc_id long, line int, kind int"),
        "line-firsts",
    )
    edges = found.where("kind > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("_first"))
    settled = found.where("kind = 1").join(edges, ["h1", "h2"]).where("doc_id > _first")
    return found.where("kind = 0").select("doc_id", "line").union(settled.select("doc_id", "line"))


def pack_bitmap(n: int, dropped: np.ndarray) -> bytes:
    """Compressed bits of ``n`` lines, 1 for a kept one."""
    keep = np.ones(n, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def keep_bitmaps(docs: DataFrame, least: int = MIN_KEY_CHARS) -> DataFrame:
    """``(doc_id, n_bits, keep)``: bitmaps of the documents that lose lines.

    ``n_bits`` reaches to the last dropped line; all lines after it are kept. Documents that are
    not listed keep every line. A null or empty text is one empty line and is never dropped, and
    a row without doc_id takes no part. Rows with equal doc_id are one document to the rule:
    each holds the first place of its keys, and lines dropped at a position go in each row.
    """

    @F.pandas_udf("binary")
    def bitmap(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: pack_bitmap(int(max(x)) + 1, np.asarray(x, np.int64)))

    grouped = repeated_lines(hash_lines(docs, least)).groupBy("doc_id").agg(F.collect_set("line").alias("_lines"))
    return grouped.select("doc_id", (F.array_max("_lines") + 1).alias("n_bits"), bitmap("_lines").alias("keep"))


def kept_lines(text: str | None, n_bits: int, keep: bytes) -> list[bytes]:
    lines = (text or "").encode().split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_bits).astype(bool)
    return [line for i, line in enumerate(lines) if i >= n_bits or bits[i]]


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with each text cut to its kept lines; ``n_chars``, where present, follows it.

    One pass over the documents beside their bitmaps; batches without a bitmap go through as they are.
    """
    columns = list(docs.columns)
    text_at = columns.index("text")
    chars_at = columns.index("n_chars") if "n_chars" in columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bits, keep = (batch.column(len(columns) + k) for k in (0, 1))
            hit = np.flatnonzero(keep.is_valid().to_numpy(zero_copy_only=False))
            out = list(batch.columns[: len(columns)])
            if len(hit):
                texts = out[text_at].to_pylist()
                sizes = out[chars_at].to_pylist() if chars_at is not None else None
                for k in hit.tolist():
                    texts[k] = b"\n".join(kept_lines(texts[k], n_bits[k].as_py(), keep[k].as_py())).decode()
                    if sizes is not None:
                        sizes[k] = len(texts[k])
                out[text_at] = pa.array(texts, batch.schema.field(text_at).type)
                if sizes is not None:
                    out[chars_at] = pa.array(sizes, batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(out, columns)

    key, n_bits, keep = free_names(docs, "bits_id", "n_bits", "keep")
    marked = docs.join(bitmaps.select("doc_id", "n_bits", "keep").toDF(key, n_bits, keep), F.col("doc_id") == F.col(key), "left")
    return marked.select(*columns, n_bits, keep).mapInArrow(freeing(cut), docs.schema)


def line_digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` of every document after its bitmap."""

    @F.pandas_udf("n_dropped long, kept_sha256 string")
    def digest(text: pd.Series, n_bits: pd.Series, keep: pd.Series) -> pd.DataFrame:
        out = []
        for t, n, k in zip(text, n_bits, keep, strict=True):
            data = (t or "").encode()
            lines = kept_lines(t, int(n), k) if k is not None else None
            kept = data if lines is None else b"\n".join(lines)
            gone = 0 if lines is None else data.count(b"\n") + 1 - len(lines)
            out.append((gone, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=["n_dropped", "kept_sha256"])

    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id",
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.col("text"),
    )
    marked = base.join(bitmaps.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")
    done = marked.withColumn("_d", digest("text", F.coalesce("n_bits", F.lit(0)), "keep"))
    return done.select("doc_id", "n_lines", "_d.n_dropped", "_d.kept_sha256")
