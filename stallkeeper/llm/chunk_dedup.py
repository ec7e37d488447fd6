"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; where its tested bits fall below a bound, a chunk ends.  The test sees the last
16 bytes only, so after an insertion the boundaries fall back into step within a few bytes.

A passage is a stretch of a document all of whose runs of ``min_words`` words stand, byte for byte, in other documents too.
Chunks say which runs can: each run is filed under the least digest of two neighbouring chunks inside it, which its own bytes decide, and
runs without such chunks (short words, repeated lines) under their own hash.  Only runs filed under a key of several documents are
compared, each by a 64-bit hash of its bytes, so a passage has its true ends and none is lost or too short, but for chance hits of the hash.

Words are parted by white space.  At the two ends of a passage signs round a word do not count: '(word' and 'word.' end like 'word'.
Null and empty texts have no words.  Rows without doc_id take no part.  Rows that repeat a doc_id are
one document as to where a run stands; of several first documents of a run the smallest id counts; texts are taken whole, however long; equal rows give equal passages once, different texts under one id each theirs.  Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import cut_out, slices, small_side

WINDOW_BITS = 16
_GEAR = np.random.default_rng(2).integers(0, 1 << 16, 256, dtype=np.uint16)
#: byte values that part words
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[data[i - k]] << k over the last 16 bytes, by doubling the window."""
    h = _GEAR[data]
    for m in (1, 2, 4, 8):
        more = h.copy()
        more[m:] += h[:-m] << np.uint16(m)
        h = more
    return h


def natural_ends(data: np.ndarray, average: int) -> np.ndarray:
    """Places behind which the hash asks for a boundary."""
    h = gear_hash(data) * np.uint16(0x9E37)  # the low bits of a gear hash see few bytes
    return np.flatnonzero(h < (1 << WINDOW_BITS) // average) + 1


def boundaries(data: np.ndarray, average: int, longest: int) -> np.ndarray:
    """End offsets of the chunks."""
    ends = natural_ends(data, average)
    ends = np.append(ends, len(data)) if not len(ends) or ends[-1] != len(data) else ends
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > longest:
        starts = ends - gaps
        ends = np.concatenate([np.append(np.arange(a + longest, b, longest), b) if b - a > longest else [b]
                               for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return ends


def chunks(docs: DataFrame, average: int = 24, longest: int = 256) -> DataFrame:
    """(doc_id, version, seq, start, end, words, digest): places in code points; words that start in the chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            ids, versions, texts = (c.to_pylist() for c in batch.columns)
            for a, b in slices(texts, 1_000_000):
                parts, marks = [], []
                for i, version, text in zip(ids[a:b], versions[a:b], texts[a:b], strict=True):
                    raw = text.encode()
                    data = np.frombuffer(raw, np.uint8)
                    ends = boundaries(data, average, longest).astype(np.int64)
                    starts = np.append(0, ends[:-1])
                    chars = np.cumsum((data & 0xC0) != 0x80)
                    space = _SPACE[data]
                    begins = np.cumsum(~space & np.append(True, space[:-1]))
                    n = len(ends)
                    parts.append((np.full(n, i), np.full(n, version), np.arange(n), np.append(0, chars[ends[:-1] - 1]) if n > 1 else np.zeros(1, np.int64),
                                  chars[ends - 1], begins[ends - 1] - np.append(0, begins[ends[:-1] - 1])))
                    marks += [digest(raw[x:y]) for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
                cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(cols, kinds, strict=True)),
                                                  pa.array(np.array(marks, np.uint64).view(np.int64))],
                                                 ["doc_id", "version", "seq", "start", "end", "words", "digest"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    return slim.filter("doc_id is not null and text <> ''").mapInArrow(
        run, "doc_id long, version long, seq int, start int, end int, words int, digest long")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}  # as many as a text of 2 MB needs; longer ones are not kept


def _powers(n: int, base: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) <= n:
        known = np.full(max(n + 1, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if len(known) <= 1 << 21:
            _POWERS[base] = known
    return known[:n + 1]


class _Sums:
    """Hashes of any slices of a row of numbers, from sums of powers."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, values: np.ndarray):
        self.sums = np.append(np.uint64(0), np.cumsum(values * _powers(len(values) - 1, self.BASE), dtype=np.uint64))
        self.back = _powers(len(values), self.INVERSE)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.back[a]


_BYTES = np.random.default_rng(3).integers(0, 1 << 64, 256, dtype=np.uint64)
#: byte values of letters and digits, and of all that is no ASCII
_INNER = np.zeros(256, bool)
_INNER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _inner(data: np.ndarray) -> np.ndarray:
    """Bytes of letters and digits; signs of U+0080 to U+00BF and U+2000 to U+203F are none."""
    out = _INNER[data]
    two = np.flatnonzero(data[:-1] == 0xC2)
    three = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
    for at in (two, two + 1, three, three + 1, three + 2):
        out[at] = False
    return out


def grams(raw: bytes, size: int, average: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(key, start, end) of each run of ``size`` words, places in bytes; None if the text is shorter.  Without ``average`` keys are hashes.

    A run reaches from the first letter or digit of its first word to the last one of its last word.  Its key is the least digest of
    two neighbouring chunks between boundaries that the run itself decides, or its hash if it holds no three such boundaries: runs
    of equal bytes have equal keys.
    """
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    n = len(starts) - size + 1
    if n < 1:
        return None
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    # the first and last inner byte of each word; a word without one counts whole
    inner = np.append(np.flatnonzero(_inner(data)), len(data))
    left = inner[np.searchsorted(inner, starts)]
    left = np.where(left < ends, left, starts)
    right = inner[np.searchsorted(inner, ends) - 1] + 1
    right = np.where((right > starts) & (right <= ends), right, ends)
    slice_hash = _Sums(_BYTES[data])
    a, b = left[:n], right[size - 1:]
    part = lambda x, y: _mixed(slice_hash(x, y) + (y - x).astype(np.uint64))

    def hashes(at: np.ndarray) -> np.ndarray:
        if size == 1:
            return part(a[at], b[at])
        words = _Sums(part(starts[:-1], starts[1:]))  # with the space behind them
        return _mixed(part(left[at], starts[at + 1]) + np.uint64(3) * _mixed(words(at + 1, at + size - 1)) + np.uint64(5) * part(starts[at + size - 1], b[at]))

    if average is None:
        return hashes(np.arange(n)), a, b
    keys, count = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    cuts = natural_ends(data, average)
    if len(cuts) > 2:
        pairs = part(cuts[:-2], cuts[2:])
        first = np.searchsorted(cuts, a + WINDOW_BITS)  # a boundary is decided by the 16 bytes before it
        count = np.searchsorted(cuts, b, "right") - first - 2
        least, width = pairs, 1
        while (count >= width).any():  # minima over 1, 2, 4, ... pairs
            own = np.flatnonzero((count >= width) & (count < 2 * width))
            keys[own] = np.minimum(least[first[own]], least[first[own] + count[own] - width])
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if len(alone := np.flatnonzero(count < 1)):
        keys[alone] = hashes(alone)
    return keys, a, b


def _gram_keys(docs: DataFrame, size: int, average: int) -> DataFrame:
    """(key, doc_id, version, first, last): the runs of words, by number, that follow each other with one key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, texts = (c.to_pylist() for c in batch.columns)
            for x, y in slices(texts, 1_000_000):
                parts = []
                for i, version, text in zip(ids[x:y], versions[x:y], texts[x:y], strict=True):
                    if (found := grams(text.encode(), size, average)) is not None:
                        keys = found[0]
                        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                        parts.append((keys[first].view(np.int64), np.full(len(first), i), np.full(len(first), version), first,
                                      np.append(first[1:], len(keys)) - 1))
                if parts:
                    cols = [np.concatenate(c).astype(t) for c, t in zip(zip(*parts, strict=True), _KEY_TYPES, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "doc_id", "version", "first", "last"])

    return docs.mapInArrow(run, "key long, doc_id long, version long, first int, last int")


_KEY_TYPES = (np.int64, np.int64, np.int64, np.int32, np.int32)


def _gram_rows(docs: DataFrame, size: int) -> DataFrame:
    """(hash, doc_id, version, number, start, length) of the runs of words in the ranges ``spans`` of their numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, texts = (batch.column(k).to_pylist() for k in range(3))
            spans = batch.column(3)
            for x, y in slices(texts, 1_000_000):
                parts = []
                for k in range(x, y):
                    raw = texts[k].encode()
                    marks, a, b = grams(raw, size, None)
                    edges = np.zeros(len(marks) + 1, np.int32)
                    own = spans[k].values
                    np.add.at(edges, own.field("first").to_numpy(), 1)
                    np.add.at(edges, own.field("last").to_numpy() + 1, -1)
                    at = np.flatnonzero(np.cumsum(edges)[:-1])
                    chars = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
                    start = chars[a[at]]
                    parts.append((marks[at].view(np.int64), np.full(len(at), ids[k]), np.full(len(at), versions[k]), at, start, chars[b[at]] - start))
                cols = [np.concatenate(c).astype(t) for c, t in zip(zip(*parts, strict=True), (*_KEY_TYPES, np.int32), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["hash", "doc_id", "version", "number", "start", "length"])

    return docs.mapInArrow(run, "hash long, doc_id long, version long, number int, start int, length int")


def repeated_passages(docs: DataFrame, min_words: int = 51, average: int = 24) -> DataFrame:
    """(doc_id, version, start, end, n_words, first_doc_id): passages of at least ``min_words`` words that other documents share.

    Up to first_doc_id every run of ``min_words`` words of the passage has been seen; it is the document itself where the passage is first.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"), "text").filter(
        "doc_id is not null and text <> ''")
    keyed = _gram_keys(slim, min_words, average)
    shared = keyed.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("key")
    asked = stage(keyed.join(shared, "key").groupBy("doc_id", "version").agg(
        F.collect_set(F.struct("first", "last")).alias("spans")).withColumnsRenamed({"doc_id": "_d", "version": "_v"}), "asked")
    texts = slim.join(small_side(asked), (F.col("doc_id") == F.col("_d")) & (F.col("version") == F.col("_v"))).select(
        "doc_id", "version", "text", "spans")
    rows = _gram_rows(texts, min_words)
    # a run is repeated if the smallest and the largest of its documents differ
    held = rows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select(
        "hash", F.col("low").alias("first"))
    placed = rows.join(held, "hash").select("doc_id", "version", "number", "start", (F.col("start") + F.col("length")).alias("end"), "first")
    order = Window.partitionBy("doc_id", "version").orderBy("number")
    before = F.lag("number").over(order)
    steps = placed.withColumn("before", before).filter("before is null or before <> number")  # rows that stand in the input twice
    fresh = F.when(F.col("before") == F.col("number") - 1, 0).otherwise(1)
    runs = steps.withColumn("run", F.sum(fresh).over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("doc_id", "version", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.count("*") + min_words - 1).alias("n_words"), F.max("first").alias("first_doc_id"))
    return runs.drop("run")


def deduplicated(docs: DataFrame, min_words: int = 51) -> DataFrame:
    """The documents, all their columns, with repeated passages left in the first document only; n_chars follows the text."""
    found = stage(repeated_passages(docs, min_words).filter("first_doc_id < doc_id").groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_s")).select(
        F.col("doc_id").alias("_d"), F.col("version").alias("_v"), "_s"), "passages")
    both = docs.join(small_side(found), (F.col("doc_id").cast("bigint") == F.col("_d")) & (F.xxhash64("text") == F.col("_v")), "left")
    return cut_out(both, "_s", "").select(*docs.columns)
