"""N-gram Jaccard join with filters under several global token orders.

Documents become sets of 64-bit shingle hashes; equal sets are one.  Under any order of all tokens, two sets with a
similarity of t or more share a token among the first ``size - ceil(t * size) + 1`` of each.  Tokens are counted over one
document of each set, and the first order puts rare ones, by hash, before common ones, by count: a text with many
shingles of its own has a prefix of nothing else and meets no one.  The prefixes are joined, with the bounds on size and
position in the join condition.  A second order, by another hash, is a filter: pairs without a common token in
those prefixes as well are dropped.  What is left is verified on the whole sets.

The result is a class for each document, not all pairs.  In a few linear rounds each set meets one leading set of its
token groups, one of the largest class there, and the classes of verified links are merged.  After that the pairs of *different* classes within a
token group are all compared, so no link is lost, while a group of near copies, by then one class, makes no pairs.  Parity
bitmaps in that join's condition bound the difference of two sets from below, so copies edited too much make none either, and a pair
that shares one of the last few tokens before the one it meets at has met there and is left out.

Null and empty texts, and texts without words, have no shingles and link with nothing; rows without doc_id have no
links either.  Whole texts are cut into shingles, however long.  Tokens of equal number follow each other by hash, and the smallest doc_id names
a class, so ties change nothing.  Rows repeating a doc_id are compared by their texts and keep a row each.  Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage, stage_last
from .common import bounded_batches, components, slices, small_side

#: Common tokens that steer the order: at most this many, so the table sent to all executors has at most 16 MB.
COMMON_TOKENS = 1_000_000
COMMON_FROM = 16
LINEAR_ROUNDS = 3
SLICE = 1_000_000  # characters that a worker handles at once
RANGE = 1 << 20  # tokens that are counted together
EARLIER = 4  # tokens before one that tell whether a pair has met
WORDS = 6  # parity bitmaps of 384 bits: they travel with each row of the last join
_BASE = np.uint64(0x9E6C63D0876A9A35)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(0, count - 1), base, np.uint64)]))


PLACES = 1 << 17  # bytes that are hashed at once
_DOWN_BASE = pow(int(_BASE), -1, 1 << 64)
_UP, _DOWN = _powers(int(_BASE), PLACES), _powers(_DOWN_BASE, PLACES)
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTE = mix(np.arange(256, dtype=np.uint64))
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]


def word_codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, codes): where the words of these bytes begin, and a hash of each.

    A running sum of bytes times powers of their places is read at both ends of a word and shifted to place 0.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    parts = -(-len(data) // PLACES)
    up, down = (_powers(pow(base, PLACES, 1 << 64), parts + 1) for base in (int(_BASE), _DOWN_BASE))
    sums, total = np.zeros(len(edges), np.uint64), np.zeros(1, np.uint64)
    for i in range(parts):
        part = data[i * PLACES:(i + 1) * PLACES]
        run = np.cumsum(_BYTE[part] * _UP[:len(part)]) * up[i] + total
        a, b = np.searchsorted(edges, [i * PLACES, i * PLACES + len(part)], side="right")
        sums[a:b] = run[edges[a:b] - i * PLACES - 1]
        total = run[-1:]
    starts = edges[0::2]
    return starts, mix((sums[1::2] - sums[0::2]) * _DOWN[starts % PLACES] * down[starts // PLACES])


def shingle_sets(texts: list[str], k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; words end at ASCII white space, A-Z count as a-z."""
    raw = [t.encode() for t in texts]
    starts, codes = word_codes(np.frombuffer(b" ".join(raw), np.uint8))
    bounds = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raw])).tolist()
    del raw
    whole = _runs(codes, k) if len(codes) >= k else codes[:0]
    for a, b in zip(bounds, bounds[1:], strict=False):
        own = np.sort(whole[a:b - k + 1]) if b - a >= k else _runs(codes[a:b], b - a)
        yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def _runs(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    if not len(codes):
        return codes
    h = np.full(len(codes) - n + 1, n, np.uint64)
    for j in range(n):
        h = h * _BASE + codes[j:j + len(h)]
    return mix(h)


class Orders:
    """Global token orders: tokens counted as common come last, by count, the others by a hash.

    Tokens are known by their first 32 + ``bits`` bits; should two agree in them, they have one rank.
    """

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, bits: int = 32):
        self.tokens, self.counts, self.bits = tokens, counts, bits

    def prefix(self, tokens: np.ndarray, length: int, seed: int) -> np.ndarray:
        rank = np.zeros(len(tokens), np.int64)
        if len(self.tokens):
            known = tokens >> np.uint64(32 - self.bits)
            place = np.minimum(np.searchsorted(self.tokens, known), len(self.tokens) - 1)
            rank = np.where(self.tokens[place] == known, self.counts[place], 0)
        return tokens[np.lexsort((tokens if seed == 0 else mix(tokens, seed), rank))[:length]]


def _digests(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, size, key), staged: the size of each document's set and the key that names it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(pc.utf8_length(texts).to_pylist(), SLICE):
                sets = list(shingle_sets(texts.slice(a, b - a).to_pylist(), k))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array([_key(s) for s in sets], pa.int64())], ["doc_id", "size", "key"])

    return stage(docs.mapInArrow(run, "doc_id long, size long, key long"), "digests")


def _counts(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """(token, n): the first 32 + ``bits`` bits of the tokens that stand in COMMON_FROM sets of ``docs`` or more, with their numbers of sets.

    Tokens travel as sorted arrays, one for each range of their first ``bits`` bits; tokens and counts take 32 bits each there.
    """
    low = np.uint64(0xFFFFFFFF)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for start, end in slices(pc.utf8_length(texts).to_pylist(), 6_000_000):
                part = texts.slice(start, end - start)
                tokens = np.concatenate([np.zeros(0, np.uint64)] + [
                    t for a, b in slices(pc.utf8_length(part).to_pylist(), SLICE) for t in shingle_sets(part.slice(a, b - a).to_pylist(), k)])
                tokens >>= np.uint64(32 - bits)
                tokens.sort()
                first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, np.int64)
                n = np.diff(np.append(first, len(tokens))).astype(np.uint32)
                tokens = tokens[first]
                cuts = np.searchsorted(tokens, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
                tokens = (tokens & low).astype(np.uint32)
                full = np.flatnonzero(cuts[1:] > cuts[:-1])
                spans = list(zip(cuts[full].tolist(), cuts[full + 1].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int32()), *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (tokens, n))],
                    ["range", "tokens", "counts"])

    def add(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        tokens, n = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32) for c in ("tokens", "counts"))
        both = (tokens.astype(np.uint64) << np.uint64(32)) | n
        both.sort()
        tokens = both >> np.uint64(32)
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        n = np.add.reduceat((both & low).astype(np.int64), first)
        keep = n >= COMMON_FROM
        named = (np.uint64(key[0].as_py()) << np.uint64(32)) | tokens[first][keep]
        return pa.table({"token": pa.array(named.view(np.int64)), "n": pa.array(n[keep])})

    return docs.select("text").mapInArrow(run, "range int, tokens binary, counts binary").groupBy("range").applyInArrow(add, "token long, n long")


def _common(docs: DataFrame, k: int, tokens: int) -> Orders:
    """The tokens of COMMON_FROM sets or more with their numbers of sets; if there are more than COMMON_TOKENS, the most common of them.

    ``tokens`` is the size of all sets, which tells how many ranges are needed for about RANGE tokens each.
    """
    bits = min(max(10, (tokens // RANGE).bit_length()), 24)
    counted = stage(_counts(docs, k, bits), "common")
    step = F.floor(F.log2("n") * 4).cast("int")
    least, room = None, COMMON_TOKENS
    for r in sorted(counted.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):  # a row for each step of the counts
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    rows = counted.filter(step >= F.lit(least)) if least is not None else counted.limit(0)
    got = rows.toArrow()
    at = np.argsort(key := got.column("token").to_numpy().view(np.uint64))
    return Orders(key[at], got.column("n").to_numpy()[at], bits)


def _prefixes(docs: DataFrame, k: int, percent: int, orders: Orders) -> DataFrame:
    """(doc_id, key, size, tokens): the prefix under the first order."""
    shared = docs.sparkSession.sparkContext.broadcast((orders.tokens, orders.counts, orders.bits))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Orders(*shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(pc.utf8_length(texts).to_pylist(), SLICE):
                sets = list(shingle_sets(texts.slice(a, b - a).to_pylist(), k))
                out = [order.prefix(s, _prefix_length(len(s), percent), 0).view(np.int64) for s in sets]
                ends = np.cumsum([0] + [len(x) for x in out], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array([_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out)))], ["doc_id", "key", "size", "tokens"])

    return docs.mapInArrow(run, "doc_id long, key long, size long, tokens array<long>")


def _key(tokens: np.ndarray) -> int | None:
    """64 bits of the digest that name a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True) if len(tokens) else None


def _prefix_length(size: int, percent: int) -> int:
    return size + (-percent * size // 100) + 1 if size else 0


def _whole_sets(docs: DataFrame, k: int, percent: int, orders: Orders) -> DataFrame:
    """(key, tokens, second, third, bits): the whole set, its prefixes under two more orders in 32 bits, and its parity bitmap.

    Bit i is the parity of the tokens that fall on i, so differing bits never exceed the tokens only one of two sets has.
    """
    shared = docs.sparkSession.sparkContext.broadcast((orders.tokens, orders.counts, orders.bits))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Orders(*shared.value)
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(pc.utf8_length(texts).to_pylist(), SLICE):
                sets = list(shingle_sets(texts.slice(a, b - a).to_pylist(), k))
                more = [[order.prefix(s, _prefix_length(len(s), percent), seed).astype(np.uint32).view(np.int32) for s in sets]
                        for seed in (1, 2)]
                odd = [np.bincount((s % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS).astype(np.uint8) & 1 for s in sets]
                bits = np.packbits(np.array(odd, np.uint8).reshape(-1, 64 * WORDS), axis=1, bitorder="little").view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([_key(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    *(pa.array(m, pa.list_(pa.int32())) for m in more),
                    pa.array(bits.tolist(), pa.list_(pa.int64()))], ["key", "tokens", "second", "third", "bits"])

    return docs.select("text").mapInArrow(run, "key long, tokens array<long>, second array<int>, third array<int>, bits array<long>")


def _possible(a: str, b: str, percent: int):
    """Bounds on the sizes and on what can be shared from the first common token on."""
    na, nb, pa_, pb = (F.col(f"{s}.{c}") for c in ("size", "pos") for s in (a, b))
    need = (na + nb) * percent / (100 + percent)
    return (na * 100 >= nb * percent) & (nb * 100 >= na * percent) & (F.least(na - pa_, nb - pb) >= need - 1e-9)


def _meet(pairs: DataFrame, sets: DataFrame, columns: list[str], test) -> DataFrame:
    """Pairs (a, b) that pass ``test`` on columns of both sets.  Only rows of pairs are shuffled while there are few."""
    few = small_side(pairs)
    side = lambda s: sets.select(F.col("key").alias(s), F.struct(*columns).alias(f"set_{s}")).join(few, s)
    return side("a").join(side("b").select("a", "b", "set_b"), ["a", "b"]).filter(test).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Staged pairs (a, b) that share tokens under the other orders too and are similar enough."""
    likely = stage(_meet(stage(pairs, "pairs"), sets, ["second", "third"], F.arrays_overlap("set_a.second", "set_b.second")
                         & F.arrays_overlap("set_a.third", "set_b.third")), "likely")
    shared = F.size(F.array_intersect("set_a.tokens", "set_b.tokens"))
    union = F.size("set_a.tokens") + F.size("set_b.tokens") - shared
    return stage(_meet(likely, sets, ["tokens"], shared * 100 >= union * percent), "links")


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _digests(slim, k)
    reps = stage(rows.filter("size > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id")), "reps")
    orders = _common(slim.join(small_side(reps), "doc_id", "left_semi"), k, rows.agg(F.sum("size")).first()[0] or 0)

    # prefixes of one document of each set; tokens that one set alone has can link nothing
    prefixes = stage(_prefixes(slim.filter("doc_id is not null"), k, percent, orders).filter("size > 0"), "prefixes")
    posted = prefixes.join(small_side(reps), ["key", "doc_id"], "left_semi").select("key", "size", F.posexplode("tokens").alias("pos", "token"))
    heat = posted.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select("token")
    posts = stage(posted.join(heat, "token"), "posts")

    met = stage(posts.select("key").distinct().join(small_side(reps), "key").select("doc_id").distinct(), "met")
    sets = stage(_whole_sets(slim.join(small_side(met), "doc_id", "left_semi"), k, percent, orders).filter(
        "key is not null"), "sets")
    if stage(sets.groupBy("key").count().filter("count > 1"), "repeats").limit(1).count():
        sets = stage(sets.dropDuplicates(["key"]), "sets")  # rows that stand in the input twice

    classes = None
    for turn in range(LINEAR_ROUNDS):
        # one of the largest class leads, another one in each round: two large classes that one lead leaves apart meet at a later one
        grouped = _with_class(posts, classes)
        lead = grouped.groupBy("token").agg(F.max(F.struct("members", F.xxhash64("key", F.lit(turn)), "class", "key", "size", "pos")).alias("lead"))
        near = grouped.join(lead, "token").withColumn("own", F.struct("size", "pos")).filter(
            (F.col("class") != F.col("lead.class")) & _possible("own", "lead", percent))
        votes = near.groupBy(F.col("key").alias("a"), F.col("lead.key").alias("b")).agg(F.count("*").alias("votes"))
        best = votes.groupBy("a").agg(F.max(F.struct("votes", "b")).alias("best"))
        found = _verified(best.select("a", F.col("best.b").alias("b")), sets, percent)
        if found.limit(1).count():  # none with this lead: the next one may still link some
            classes = _merged(classes, found)

    # what may still link two classes: every pair of different classes in a token group
    grouped = _with_class(posts, classes).drop("members")
    mixed = grouped.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    words = [F.element_at("bits", w + 1).alias(f"w{w}") for w in range(WORDS)]
    own = Window.partitionBy("key").orderBy("pos")
    earlier = [F.lag("token", k).over(own).alias(f"e{k}") for k in range(1, EARLIER + 1)]
    open_ = stage(grouped.join(mixed.select("token"), "token").join(sets.select("key", *words), "key").select("*", *earlier), "open")
    carried = ["key", "size", "pos", "class", *[f"w{w}" for w in range(WORDS)], *[f"e{k}" for k in range(1, EARLIER + 1)]]
    side = lambda s: open_.select("token", F.struct(*carried).alias(s))
    differ = sum((F.bit_count(F.col(f"x.w{w}").bitwiseXOR(F.col(f"y.w{w}"))) for w in range(WORDS)), F.lit(0))
    # two sets that share enough differ in at most this many tokens
    apart = (F.col("x.size") + F.col("y.size")) * (100 - percent) / (100 + percent)
    # a pair that shares an earlier token passes the bounds there as well, so it need not be met again
    again = F.lit(False)
    for i in range(1, EARLIER + 1):
        for j in range(1, EARLIER + 1):
            again |= F.coalesce(F.col(f"x.e{i}") == F.col(f"y.e{j}"), F.lit(False))
    pairs = side("x").join(side("y"), "token").filter(
        (F.col("x.class") < F.col("y.class")) & _possible("x", "y", percent) & ~again & (differ <= apart + 1e-9)
    ).select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    classes = _merged(classes, _verified(pairs, sets, percent))

    named = reps.join(classes.select(F.col("id").alias("key"), "component"), "key", "left").select(
        "key", "doc_id", F.coalesce("component", "key").alias("class"))
    lowest = named.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    final = named.join(lowest, "class").select("key", "component_id")
    return rows.join(final, "key", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _with_class(posts: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``posts`` with the class of each set so far and its number of members; a set without links is its own class."""
    if classes is None:
        return posts.select("*", F.col("key").alias("class"), F.lit(1).cast("bigint").alias("members"))
    sized = classes.join(classes.groupBy("component").agg(F.count("*").alias("members")), "component")
    return posts.join(sized.select(F.col("id").alias("key"), F.col("component").alias("class"), "members"), "key", "left").withColumn(
        "class", F.coalesce("class", "key")).withColumn("members", F.coalesce("members", F.lit(1)))


def _merged(classes: DataFrame | None, found: DataFrame) -> DataFrame:
    """Staged (id, component) after the links ``found``; only classes that they join are looked at again."""
    if classes is None:
        return stage(components(found), "classes")
    side = lambda s: classes.select(F.col("id").alias(s), F.col("component").alias(f"class_{s}"))
    edges = found.join(side("a"), "a", "left").join(side("b"), "b", "left").select(
        F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))
    moved = stage(components(edges), "moved")
    known = classes.unionByName(moved.select("id", F.col("id").alias("component"))).distinct()
    return stage(known.join(moved.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select(
        "id", F.coalesce("to", "component").alias("component")), "classes")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the smallest of their class, all columns; rows without doc_id stay."""
    keep = stage_last(lambda: jaccard_classes(docs, k, percent).filter("doc_id = component_id").select(
        F.col("doc_id").alias("_kept")).distinct(), "kept")
    mine = F.col("doc_id").cast("bigint")
    return docs.join(small_side(keep), mine == F.col("_kept"), "left").filter(mine.isNull() | F.col("_kept").isNotNull()).select(*docs.columns)
