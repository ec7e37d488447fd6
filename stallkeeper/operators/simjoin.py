"""Exact set-similarity join (Jaccard above a threshold) without a cross join of documents.

Equal token sets are first folded into one representative.  Distinct sets are
then matched through their rare tokens only (prefix filtering): sets of size
x and y with similarity of at least t share ceil(t/(1+t)*(x+y)) tokens, so one
of the first x-ceil(t*x)+1 tokens in rare-first order is shared.  A pair is
met from its smaller set only, for which the first x-ceil(2t/(1+t)*x)+1 tokens
are enough.

Neither tokens nor pairs that are met this way are written: there are many more of
them than of similar pairs.  Prefixes, as numbers, and parity bitmaps are dealt into
blocks of sets of like size, one row each.  Each pair of blocks whose sizes allow it is one
cell, where one prefix list is looked up in the other under the bounds on sizes and positions, and
the bitmaps then bound the difference of a pair from below.  Cells read the staged blocks and shuffle nothing.
Tokens are numbers of 32 bits up to there, and those that share a number count as one token twice:
that can only raise what two sets seem to share, so it costs no pair.  What is left is verified
on the words of the sets, again in cells, which follow groups of like sets: a set
travels to the few cells that hold a pair of it, not once with each pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stage

BITMAP_BLOCK, TOKEN_BLOCK = 65_536, 512  # pairs whose bitmaps are compared at once; sets of one side of a cell with words
BLOCK_TOKENS, LEAST_TOKENS = 1_000_000, 250_000  # prefix tokens of a block; those for which another block is worth its cells
LEAST_BLOCKS = 16
MEET = 250_000  # tokens, or common ones, that a worker looks at together
WORDS = 500_000  # words of bitmaps that are compared at once, at most
SLOT_BITS = 22  # the table of common tokens that all executors get has 4 bytes for each of 2 ** SLOT_BITS slots
COMMON_FROM = 16
BROADCAST_ROWS = 1_000_000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows go to the Python workers by ``rows`` for what is staged inside."""
    before = spark.conf.get(_BATCH_KEY, None)
    spark.conf.set(_BATCH_KEY, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_KEY) if before is None else spark.conf.set(_BATCH_KEY, before)


def _digest() -> F.Column:
    """Names the set in ``tokens``; words hold no blank."""
    return F.sha2(F.concat_ws(" ", F.sort_array("tokens")), 256)


def token_codes(docs: DataFrame, id_col: str, tokens_sql: str) -> DataFrame:
    """(id, digest, size, codes), staged: the set of each document that has words, its tokens as 32 bits of a hash."""
    sets = docs.select(F.col(id_col).alias("id"), F.expr(f"array_distinct({tokens_sql})").alias("tokens"))
    coded = sets.select("id", _digest().alias("digest"), F.size("tokens").alias("size"),
                        F.transform("tokens", lambda x: F.shiftright(F.xxhash64(x), 32).cast("int")).alias("codes"))
    return stage(coded, "codes").filter("size > 0")


def fold_equal_sets(sets: DataFrame) -> DataFrame:
    """(id, rep, digest, size, copies): ``rep`` is the lowest id with the same token set.

    A set with very many copies aggregates before the shuffle and joins back as one row.
    """
    keyed = sets.select("id", "digest", "size")
    reps = keyed.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    return keyed.join(reps, "digest").select("id", "rep", "digest", "size", "copies")


def _order(sets: DataFrame) -> np.ndarray:
    """The place of each slot of codes in the global order: slots counted as common last, by count.

    Any order gives the same pairs; that copies are counted too does no harm.
    """
    slot = F.col("code").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    counted = sets.select(F.explode("codes").alias("code")).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    got = counted.filter(F.col("n") >= COMMON_FROM).toArrow()  # a row for each slot at most
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    counts[got["slot"].to_numpy()] = got["n"].to_numpy()
    place = np.empty(1 << SLOT_BITS, np.uint32)
    place[np.argsort(counts, kind="stable")] = np.arange(1 << SLOT_BITS, dtype=np.uint32)
    return place


def _kept(sizes: np.ndarray, share: float) -> np.ndarray:
    """Length of the prefix of which two sets that share more than ``share`` of theirs have a token in common."""
    return (sizes - np.ceil(sizes * share - 1e-9) + 1).astype(np.int64)


def _runs(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbours whose counts make about ``most`` together, one of them at least."""
    ends, a = np.cumsum(counts), 0
    while a < len(counts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield slice(a, b)
        a = b


class Blocks:
    """Which block a set of some size belongs to, and the bits of its bitmap there.

    Blocks hold neighbouring sizes; one that would get too much of a single size shares it with others by a hash.
    """

    def __init__(self, sizes: np.ndarray, counts: np.ndarray, threshold: float, tokens: int, sets: int):
        self.sizes, self.first, self.parts, self.bits = sizes, np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        weight = counts * _kept(sizes, threshold)
        block = held = rows = 0
        for i in range(len(sizes)):
            if held and (held + weight[i] > tokens or rows + counts[i] > sets):
                block, held, rows = block + 1, 0, 0
            self.first[i] = block
            if (parts := max(-(-weight[i] // tokens), -(-counts[i] // sets))) > 1:
                self.parts[i] = parts
                block, held, rows = block + int(parts), 0, 0
            else:
                held, rows = held + weight[i], rows + counts[i]
        for b in np.unique(self.first):
            most = int(sizes[self.first == b].max())
            self.bits[self.first == b] = max(512, 1 << (4 * most - 1).bit_length())


def _varied(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary values of these lengths, in bytes, one after the other in ``data``."""
    ends = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _prefixes(sets: DataFrame, kind: str, blocks: Blocks, order: np.ndarray, threshold: float) -> DataFrame:
    """(block, rep, size, prefix, bitmap): the first tokens of each set, as numbers in the global order, and its parity bitmap.

    Bit i is the parity of the tokens that fall on i, so differing bits never exceed the tokens only one of two sets has.
    """
    shared = sets.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            for part in _runs(lengths, MEET):
                reps, mixed, codes = (batch.column(c).slice(part.start, part.stop - part.start) for c in (0, 2, 3))
                sizes, codes = lengths[part].astype(np.int64), codes.flatten().to_numpy().view(np.uint32)
                ranked = (order[codes & np.uint32((1 << SLOT_BITS) - 1)].astype(np.uint64) << np.uint64(32 - SLOT_BITS)) | (codes >> np.uint32(SLOT_BITS))
                owner = np.repeat(np.arange(len(sizes)), sizes)
                ranked |= owner.astype(np.uint64) << np.uint64(32)
                ranked.sort()
                ranked &= np.uint64(0xFFFFFFFF)
                place = np.searchsorted(blocks.sizes, sizes)
                kept, bits = _kept(sizes, threshold), blocks.bits[place]
                prefix = ranked[np.arange(len(ranked)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < kept[owner]].astype(np.uint32)
                at = (np.cumsum(bits) - bits)[owner] + (ranked.astype(np.int64) & (bits[owner] - 1))
                odd = np.zeros(int(bits.sum()), np.uint8)
                np.bitwise_xor.at(odd, at, 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks.first[place] + mixed.to_numpy() % blocks.parts[place], pa.int64()), reps, pa.array(sizes),
                    _varied(prefix, kept * 4).cast(pa.binary()), _varied(np.packbits(odd, bitorder="little"), bits // 8).cast(pa.binary())],
                    ["block", "rep", "size", "prefix", "bitmap"])

    mixed = F.shiftrightunsigned(F.xxhash64("rep"), 2).alias("mixed")
    return sets.select("rep", "size", mixed, "codes").mapInArrow(run, f"block long, rep {kind}, size long, prefix binary, bitmap binary")


def _packed(table: pa.Table) -> pa.Table:
    """The sets of a block as one row, small ones first."""
    table = table.take(pc.sort_indices(table, [("size", "ascending"), ("rep", "ascending")])).combine_chunks()
    sizes, reps = table["size"].to_numpy(), table["rep"].combine_chunks()
    whole = lambda c: pa.array([b"".join(table[c].to_pylist())], pa.binary())
    return pa.table({"block": table["block"].slice(0, 1), "low": [int(sizes[0])], "high": [int(sizes[-1])], "sizes": pa.array([sizes.tobytes()], pa.binary()),
                     "reps": pa.ListArray.from_arrays(pa.array([0, len(reps)], pa.int32()), reps), "prefixes": whole("prefix"), "bitmaps": whole("bitmap")})


class _Block:
    """A block as arrays; ``start`` has the place of each set's prefix in ``codes``."""

    def __init__(self, row: dict[str, pa.Scalar], threshold: float):
        self.sizes, self.codes = np.frombuffer(row["sizes"].as_buffer(), np.int64), np.frombuffer(row["prefixes"].as_buffer(), np.uint32)
        self.reps, self.bitmaps = row["reps"].values, np.frombuffer(row["bitmaps"].as_buffer(), np.uint64).reshape(len(self.sizes), -1)
        kept = _kept(self.sizes, threshold)
        self.start = np.zeros(len(kept) + 1, np.int64)
        np.cumsum(kept, out=self.start[1:])
        self.owner = np.repeat(np.arange(len(kept), dtype=np.int32), kept)

    def sorted(self, kept: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Tokens in the global order: code and place as one key, set, tokens from it to the end of its set, and code before it (-1: none)."""
        key = (self.codes.astype(np.uint64) << np.uint64(32)) | np.arange(len(self.codes), dtype=np.uint64)
        if kept is not None:
            key = key[np.arange(len(key)) - self.start[self.owner] < kept[self.owner]]
        key.sort()
        place = key.astype(np.uint32)
        owner = self.owner[place]
        pos = (place - self.start[owner]).astype(np.int32)
        return key, owner, self.sizes[owner].astype(np.int32) - pos, np.where(pos > 0, self.codes[place.astype(np.int64) - 1].astype(np.int64), -1)

    def folded(self, words: int) -> np.ndarray:
        """Bitmaps of fewer words; a bit is the parity of all that fall on it."""
        return np.bitwise_xor.reduce(self.bitmaps.reshape(len(self.sizes), -1, words), axis=1)


def _met(x: _Block, y: _Block, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Sets of ``x`` and of ``y``, not smaller, that share a prefix token and whose bitmaps leave enough in common."""
    t = threshold
    key, xs, x_left, x_before = x.sorted(_kept(x.sizes, 2 * t / (1 + t)))
    y_key, ys, y_left, y_before = y.sorted()
    x_size, y_size = x.sizes[xs], y.sizes[ys]
    code = key & ~np.uint64(0xFFFFFFFF)
    # sets of y are in the order of their sizes, so those that fit stand together under each token
    most = np.searchsorted(y.sizes * t, x.sizes)
    least = np.arange(1, len(x.sizes) + 1) if same else np.zeros(len(x.sizes), np.int64)
    low = np.searchsorted(y_key, code | y.start[least[xs]].astype(np.uint64))
    count = np.maximum(np.searchsorted(y_key, code | y.start[most[xs]].astype(np.uint64)) - low, 0)
    some = np.flatnonzero(count)
    low, count = low[some], count[some]
    words = min(x.bitmaps.shape[1], y.bitmaps.shape[1])
    x_bits, y_bits = x.folded(words), y.folded(words)
    found, step = [np.zeros(0, np.uint64)], max(1, min(BITMAP_BLOCK, WORDS // words))
    for part in _runs(count, MEET):
        n = count[part]
        p = np.repeat(some[part], n)
        q = np.arange(len(p)) + np.repeat(low[part] - (np.cumsum(n) - n), n)
        both = x_size[p] + y_size[q]
        # at the first shared token nothing before it is shared; a pair that shares the token before has met there
        keep = (np.minimum(x_left[p], y_left[q]) > both * (t / (1 + t))) & ((x_before[p] != y_before[q]) | (x_before[p] < 0))
        u, v, both = xs[p[keep]], ys[q[keep]], both[keep]
        for at in range(0, len(u), step):
            i, j, m = u[at:at + step], v[at:at + step], both[at:at + step]
            differ = np.bitwise_count(x_bits[i] ^ y_bits[j]).sum(axis=1, dtype=np.int64)
            # shared tokens are at most half of what the differing bits leave
            near = m - differ > m * (2 * t / (1 + t))
            found.append(np.unique((i[near].astype(np.uint64) << np.uint64(32)) | j[near].astype(np.uint64)))
    pairs = np.unique(np.concatenate(found))
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)


def likely_pairs(blocks: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(a, b), a < b, staged: pairs of sets that may be similar enough.

    Blocks are numbered by size, so the smaller set of a pair stands in the first block.  A cell reads its blocks; none is shuffled.
    """
    side = lambda s: blocks.select([F.col(c).alias(f"{s}_{c}") for c in blocks.columns])
    cells = side("x").join(side("y"), (F.col("x_block") <= F.col("y_block")) & (F.col("x_high") > F.col("y_low") * threshold))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                one, other = (_Block({c[2:]: v for c, v in row.items() if c[0] == s}, threshold) for s in "xy")
                x, y = _met(one, other, row["x_block"] == row["y_block"], threshold)
                for at in range(0, len(x), 100_000):
                    yield pa.RecordBatch.from_arrays([one.reps.take(pa.array(x[at:at + 100_000])), other.reps.take(pa.array(y[at:at + 100_000]))], ["u", "v"])

    with _batches(blocks.sparkSession, 1):
        met = cells.mapInArrow(run, f"u {kind}, v {kind}")
        return stage(met.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).filter("a < b").distinct(), "likely")


def in_cells(pairs: DataFrame, sets: DataFrame, block: int, check: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``check(pairs, sets)`` of every cell; ``pairs`` (a, b), a < b, is staged, ``sets`` has a ``rep``.

    Sets are dealt into blocks of about ``block``, counting only those that have a pair, so a cell has a
    bounded size whatever the number of sets.  Sets with the same lowest partner go to one block, unless
    they are more than that, so most pairs of a group of like sets stand in one cell.
    """
    busy = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    blocks = max(1, -(-busy.count() // block))
    lowest = pairs.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("lead"))
    led = busy.join(lowest, "rep", "left").withColumn("lead", F.coalesce("lead", "rep"))
    crowds = led.groupBy("lead").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")).filter("parts > 1")
    part = F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1)))
    # at most one row for each full block
    dealt_to = led.join(F.broadcast(crowds), "lead", "left").select("rep", (F.pmod(F.xxhash64("lead"), F.lit(blocks)) + part * blocks).alias("at"))
    to = lambda s, place: dealt_to.select(F.col("rep").alias(s), F.col("at").alias(place))
    dealt = stage(pairs.join(to("a", "i"), "a").join(to("b", "j"), "b").select("a", "b", "i", "j"), "dealt")
    wanted = dealt.select(F.col("i").alias("row"), F.col("j").alias("col"), F.explode(F.array("a", "b")).alias("rep")).distinct()
    return dealt.groupBy("i", "j").cogroup(wanted.join(sets, "rep").groupBy("row", "col")).applyInArrow(check, schema)


def _places(column: pa.ChunkedArray) -> dict:
    """Places of each value; an id that stands on several rows has them all."""
    found: dict = {}
    for k, value in enumerate(column.to_pylist()):
        found.setdefault(value, []).append(k)
    return found


def _matched(pairs: pa.Table, sets: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Rows of ``pairs`` with the places of both sets, in the order of the first."""
    places = _places(sets["rep"])
    hits = [(p, x, y) for p, (a, b) in enumerate(zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()))
            for x in places.get(a, ()) for y in places.get(b, ())]
    row, x, y = np.array(sorted(hits, key=lambda h: h[1]), dtype=np.int64).reshape(-1, 3).T
    return pairs.take(pa.array(row)), x, y


def _verified(threshold: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Pairs of a cell above ``threshold``, from their full sets."""
    def check(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        pairs, x, y = _matched(pairs, sets)
        tokens = sets["tokens"].combine_chunks()
        coded = tokens.flatten().dictionary_encode()
        sizes = pc.list_value_length(tokens).to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        codes = np.split(coded.indices.to_numpy(), ends[:-1])
        both = np.zeros(len(x), dtype=np.int64)
        mark = np.zeros(len(coded.dictionary), dtype=bool)
        marked = -1
        for k, (u, v) in enumerate(zip(x.tolist(), y.tolist())):
            if u != marked:
                if marked >= 0:
                    mark[codes[marked]] = False
                mark[codes[u]] = True
                marked = u
            both[k] = np.count_nonzero(mark[codes[v]])
        similarity = both.astype(np.float64) / (sizes[x] + sizes[y] - both)
        copies = sets["copies"].combine_chunks()
        made = pa.table({"doc_a": pairs["a"], "doc_b": pairs["b"], "similarity": similarity,
                         "copies_a": copies.take(pa.array(x)), "copies_b": copies.take(pa.array(y))})
        return made.filter(pa.array(similarity > threshold))
    return check


def jaccard_join(docs: DataFrame, id_col: str, tokens_sql: str, threshold: float = 0.5,
                 hot_token: int = 20_000) -> DataFrame:
    """Pairs with similarity above ``threshold``.

    Result rows (doc_a < doc_b, similarity, copies_a, copies_b):
    * one row per pair of different token sets, named by their representatives;
    * one row from a representative to each of its copies (similarity 1).
    A pair of any two documents follows from their representatives, so the
    result is whole but stays linear in the number of copies.

    A block has at most ``hot_token`` sets, so no cell looks at more of them under one token.
    """
    spark, t = docs.sparkSession, threshold
    with _batches(spark, 1_000):
        codes = token_codes(docs, id_col, tokens_sql)
        folded = stage(fold_equal_sets(codes), "folded")
        kind = dict(folded.dtypes)["rep"]
        # rows that stand in the input twice are one set
        reps = folded.filter(F.col("id") == F.col("rep")).select("rep", "digest", "size", "copies").distinct()
        spread = reps.groupBy("size").agg(F.count("*").alias("n")).orderBy("size").toArrow()  # a row for each size
        sizes, counts = spread["size"].to_numpy().astype(np.int64), spread["n"].to_numpy()
        tokens = int((counts * _kept(sizes, t)).sum())
        room = max(min(BLOCK_TOKENS, tokens // LEAST_BLOCKS), LEAST_TOKENS)
        firsts = codes.join(reps.select("digest", F.col("rep").alias("id"), "rep"), ["digest", "id"]).dropDuplicates(["digest"])
        prefixes = _prefixes(firsts, kind, Blocks(sizes, counts, t, room, hot_token), _order(codes), t)
        blocks = stage(prefixes.groupBy("block").applyInArrow(
            _packed, f"block long, low long, high long, sizes binary, reps array<{kind}>, prefixes binary, bitmaps binary"), "blocks")
    likely = likely_pairs(blocks, kind, t)

    busy = stage(likely.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "busy")
    few = F.broadcast(busy) if busy.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else busy
    words = docs.withColumnRenamed(id_col, "rep").join(few, "rep").select("rep", F.expr(f"array_distinct({tokens_sql})").alias("tokens"))
    named = words.select("rep", "tokens", _digest().alias("digest")).join(reps.select("rep", "digest", "copies"), ["rep", "digest"])
    sets = stage(named.dropDuplicates(["rep", "digest"]).select("rep", "tokens", "copies"), "sets")
    checked = in_cells(likely, sets, TOKEN_BLOCK, _verified(t),
                       f"doc_a {kind}, doc_b {kind}, similarity double, copies_a bigint, copies_b bigint")
    same = folded.filter(F.col("id") != F.col("rep")).select(
        F.col("rep").alias("doc_a"), F.col("id").alias("doc_b"), F.lit(1.0).alias("similarity"),
        F.col("copies").alias("copies_a"), F.col("copies").alias("copies_b"),
    )
    return checked.unionByName(same)
