"""Best-fit packing of documents into training sequences by the sum of squares.

A document is its token ids and an end id.  One longer than ``capacity`` is cut into pieces of that many tokens, the first of which
may be shorter; pieces of full length are sequences of their own.  The others are placed one after the other, the longest first:
among the open sequences with room, a piece goes where the sum over all gaps of the squared number of open sequences with that gap
becomes smallest (ties: the smaller gap); only a piece that fits nowhere opens a sequence.  A placement needs lengths alone.

Pieces are dealt by a hash of their row to groups of about ``group_rows``, each packed in one task.  Sequences that end with more than
``slack`` free tokens are opened again, and their pieces meet those of the other groups in the next round, until one group is left
or a round frees nothing.  So a group costs no more than its share of the last round's waste, at any number of groups.

Null text is empty and has the end id alone.  Each row is a document: rows repeating a doc_id or without one are packed by themselves.
Pieces of equal length are placed in the order of their rows.  Whole texts are encoded, however long; only their pieces travel.
An empty table gives no pieces.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .byte_bpe import byte_bpe
from .common import slices

CAPACITY = 1024
GROUP_ROWS = 4096  # pieces that one task places together
FAR = 1 << 60


def cuts(n: int, capacity: int) -> list[int]:
    """Bounds of the pieces of a document of ``n`` tokens."""
    if n <= capacity:
        return [0, n]
    return [0, *range(n % capacity or capacity, n + 1, capacity)]


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, free tokens of the sequence at the end) of each piece; no piece is empty or longer than ``capacity``."""
    count = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    held: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    gaps: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = count[n:capacity]
        change = np.where(room > 0, 2 - 2 * room, FAR)  # of the sum of squares, for each gap from n on
        change[1:] += 2 * count[1:capacity - n]
        change[:1] -= 1  # a filled sequence is open no longer
        best = int(change.argmin()) if len(change) else 0
        if len(change) and change[best] < FAR // 2:
            gap = n + best
            count[gap] -= 1
            s = held[gap].pop()
        else:
            gap, s = capacity, len(gaps)
            gaps.append(capacity)
        sequence[i], offset[i] = s, capacity - gap
        gaps[s] = gap - n
        if gap > n:
            count[gap - n] += 1
            held[gap - n].append(s)
    return sequence, offset, np.asarray(gaps, np.int64)[sequence] if gaps else offset


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) and, if asked for, the ids of every piece, staged."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts, 1_000_000):
                rows, parts = [], []
                for doc_id, text in zip(doc_ids[a:b], texts[a:b], strict=True):
                    ids = np.append(bpe.ids(text), np.uint32(end_id)).astype("<u4", copy=False)
                    bounds = cuts(len(ids), capacity)
                    for k, (x, y) in enumerate(zip(bounds, bounds[1:])):
                        part = ids[x:y]
                        rows.append((doc_id, k, x, y - x, zlib.crc32(part)))
                        if keep_ids:
                            parts.append(part)
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int32()] + [pa.int64()] * 3, strict=True)]
                if keep_ids:
                    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stage(slim.mapInArrow(encode, schema).withColumn("row", F.monotonically_increasing_id()), "pieces")


def place(cut: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, slack: int | None = None) -> DataFrame:
    """``cut``, staged rows with a unique ``row`` and a ``length``, with sequence_id and offset."""
    slack = capacity // 64 if slack is None else slack
    columns = [c for c in cut.columns if c != "_group"]
    schema = ", ".join(f"`{n}` {t}" for n, t in cut.select(columns).dtypes) + ", sequence_id long, offset long, free long"

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("_group")[0].as_py()
        table = table.drop_columns(["_group"]).sort_by("row")
        sequence, offset, free = sum_of_squares(table.column("length").to_numpy(), capacity)
        return table.append_column("sequence_id", pa.array(sequence + (group << 16))).append_column(
            "offset", pa.array(offset)).append_column("free", pa.array(free))

    done = [cut.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("bigint"))]
    todo = cut.filter(F.col("length") < capacity)
    left = todo.count()
    used = 0  # groups of the earlier rounds, so that numbers stay apart
    while left:
        groups = -(-left // group_rows)
        group = F.lit(used) + F.pmod(F.xxhash64("row", F.lit(used)), F.lit(groups))
        packed = stage(todo.withColumn("_group", group.cast("bigint")).groupBy("_group").applyInArrow(pack, schema), "packed")
        loose = packed.filter(F.col("free") > slack)
        again = loose.count() if groups > 1 else 0
        if again > left // 2:
            again = 0  # nearly all sequences stay loose: another round would not mend it
        done.append((packed.filter(F.col("free") <= slack) if again else packed).select(*columns, "sequence_id", "offset"))
        todo, left, used = loose.select(*columns), again, used + groups
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    return place(pieces(docs, tokenizer, capacity, end_id), capacity, group_rows).drop("row")


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The sequences themselves: (sequence_id, doc_ids, offsets, ids), at most ``capacity`` tokens each."""
    placed = place(pieces(docs, tokenizer, capacity, end_id, keep_ids=True), capacity, group_rows)
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id", F.col("_parts.doc_id").alias("doc_ids"), F.col("_parts.offset").alias("offsets"), F.flatten("_parts.ids").alias("ids"))
