"""Token-ID files: length-delimited binary records with masked checksums and an offset index.

A file is a run of records::

    u64 length | u32 masked crc of the length | payload | u32 masked crc of the payload | 0x0A

with payload ``u8 flags | i64 doc_id | u8 id width | ids``; numbers are little-endian, flag 1 means
that the document has no id.  The closing byte is the record separator of Spark's text writer, which
writes the records as they are, to any store Spark can reach; readers go by the lengths only.  The
mask ``rotate(crc, 15) + 0xa282ead8`` keeps checksums of data that holds checksums apart.

The writer takes bundles of records, of 1 MB or one larger record, and starts a new file after 32 of them: a file holds
at most 32 MB, if no single record is larger than a bundle.

Null text is empty, so it has the end id alone; rows that repeat a doc_id are written one after the
other, by the first 32 characters of their texts and then by a hash; rows without doc_id come first.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import shuffle_width, stage, staging_path
from .byte_bpe import byte_bpe

_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<BqB")
_CRC = struct.Struct("<I")
RANGE_BYTES = 64 << 20  # of text in a range, on average
BUNDLE_BYTES = 1 << 20  # records that the writer takes as one row
FILE_BUNDLES = 32  # rows of a file


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    payload = _BODY.pack(doc_id is None, doc_id or 0, ids.itemsize) + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, _CRC.pack(masked_crc(length)), payload, _CRC.pack(masked_crc(payload))))


def records(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, bytes, doc_id, ids) of each record; raises on a damaged one."""
    at = 0
    while at < len(content):
        length, crc = _HEAD.unpack_from(content, at)
        if crc != masked_crc(content[at:at + 8]):
            raise ValueError(f"damaged length at {at}")
        body = at + _HEAD.size
        payload = content[body:body + length]
        if len(payload) != length or masked_crc(payload) != _CRC.unpack_from(content, body + length)[0]:
            raise ValueError(f"damaged record at {at}")
        none, doc_id, width = _BODY.unpack_from(payload)
        size = _HEAD.size + length + _CRC.size + 1
        yield at, size, None if none else doc_id, np.frombuffer(payload, f"<u{width}", offset=_BODY.size)
        at += size


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, range_bytes: int = RANGE_BYTES,
                      bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Encode whole texts and write them in ascending doc_id order, some files of bounded size for each range of rows.

    Ranges are cut by (doc_id, start of the text, its hash, row), so the rows without doc_id or with one repeated doc_id fill as many
    ranges as they need; there are as many as the bytes of the texts ask for.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        end = np.asarray([end_id], bpe.dtype)
        held: list[bytes] = []
        size = 0
        bundle = lambda: pa.RecordBatch.from_arrays([pa.array([b"\n".join(held)], pa.binary())], ["record"])
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in zip(doc_ids, texts, strict=True):
                record = frame(i, np.append(bpe.ids(text).astype(bpe.dtype), end))
                if held and size + len(record) > bundle_bytes:
                    yield bundle()
                    held, size = [], 0
                held.append(record)
                size += len(record) + 1
        if held:
            yield bundle()

    text = F.coalesce("text", F.lit(""))
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["doc_id", "lead", "mark", "row"]
    keyed = slim.select("doc_id", "text", F.substring("text", 1, 32).alias("lead"), F.xxhash64("text").alias("mark"),
                        F.monotonically_increasing_id().alias("row"))
    ranges = max(shuffle_width(docs.sparkSession), -(-size // range_bytes))
    ranged = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "text")
    framed = ranged.mapInArrow(encode, "record binary")
    framed.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", FILE_BUNDLES).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, n_bytes, doc_id, n_tokens, ids_crc32): every record, its checksums tested.

    ids_crc32 is taken over the ids as unsigned 32-bit integers, whatever their width in the file.
    """

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [(name, at, size, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for at, size, doc_id, ids in records(content.as_buffer().to_pybytes())]
                cols = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [pa.string()] + [pa.int64()] * 5, strict=True)],
                    ["file", "offset", "n_bytes", "doc_id", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter("length > 0").select(name.alias("file"), "content").mapInArrow(
        parse, "file string, offset long, n_bytes long, doc_id long, n_tokens long, ids_crc32 long")


def read_record(content: bytes, offset: int) -> tuple[int | None, list[int]]:
    """One record of a file by its offset in the index, for reads in any order."""
    length = struct.unpack_from("<Q", content, offset)[0]
    _, _, doc_id, ids = next(records(content[offset:offset + _HEAD.size + length + _CRC.size + 1]))
    return doc_id, ids.tolist()


def token_file_index(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None, **sizes: int) -> DataFrame:
    """Write the files and their index; the index with the place of each document in the token stream.

    Files are numbered in the order of their ids (part of the writer, file of the part), so a total per file and a running total within it give ``start``.
    """
    spark = docs.sparkSession
    path = path or staging_path(spark, "tokens")
    write_token_files(docs, f"{path}/records", tokenizer, end_id, **sizes)
    read_token_files(spark, f"{path}/records").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    totals = stage(index.groupBy("file").agg(F.sum("n_tokens").alias("total")), "totals")  # a row for each file
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("long")
    before = totals.select("file", (F.sum("total").over(Window.orderBy(number(r"^part-(\d+)"), number(r"-c(\d+)[^-]*$"))) - F.col("total")).alias("base"))
    inside = Window.partitionBy("file").orderBy("offset")
    return index.withColumn("inner", F.sum("n_tokens").over(inside) - F.col("n_tokens")).join(before, "file").withColumn(
        "start", F.col("base") + F.col("inner")).drop("base", "inner")
