"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut where no piece of the vocabulary can reach across (before a run of blanks, and between letters and other
characters, if the piece table shows that).  The distinct words of a block of documents become a lattice: all substrings of
bounded length are exploded and equi-joined to the piece table, the edges are grouped by word, and a fold
with Spark's higher-order aggregate finds the segmentation:

* ``fold="viterbi"``: the path with the highest total score, as a unigram model defines it;
* ``fold="merges"``: the merges of a BPE model replayed on the same edges, best score first, ties to the left.  A BPE model's
  result is not its best path (they agree on 40 to 66 % of the words of the test texts), so this is the default.

A character without a piece becomes its UTF-8 bytes.  Documents form blocks of bounded size by the partition that reads them and their order in it.
Of a block travel its distinct words, and of a text the numbers of its words there, never the text itself: each word of the corpus is
encoded once, and its ids meet the numbers of its blocks for the assembly.  Texts are cut into words twice, for either; should a block
hold other words when it is read again, its texts go through the sentencepiece library, and so do words longer than ``longest`` characters
(64 at most, as the cuts of a word are the bits of one number), with the same result.

Null and empty texts have no ids.  Rows are encoded one by one, so ties, repeated rows and null ids need no rule.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import stage
from .common import bounded_batches, slices

BLANK = "▁"
BLOCK_CHARS = 32_000_000
WORDS_AT_ONCE = 80_000
SLICE = 1_000_000  # characters that are cut into words at once
STEP = 1 << 20  # edge key: start * STEP + end
ID_BITS, END_BITS = 21, 7  # packed edge: rank of the score, start, end, id
START_AT, RANK_AT = ID_BITS + END_BITS, ID_BITS + 2 * END_BITS
ODD = 1 << ID_BITS - 1  # flag of a packed edge whose merge may come out of the order of scores
POS_BITS = 28  # place of a word: block, number in it


class Pieces:
    """The piece table of a model and what follows from it."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.rows = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in plain]
        self.first_byte = next((i for i in range(n) if sp.is_byte(i)), None)
        self.longest = max((len(p) for p, _, _ in self.rows), default=1)
        self.surface = [bytes([i - self.first_byte]) if sp.is_byte(i) else b"" if sp.is_control(i) else
                        sp.id_to_piece(i).replace(BLANK, " ").encode() for i in range(n)]
        kind = lambda c: 0 if c == BLANK else 1 if c.isalpha() else 2
        crossing = {(kind(a), kind(b)) for p, _, _ in self.rows for a, b in zip(p, p[1:], strict=False)}
        if {(1, 0), (2, 0)} & crossing:
            raise ValueError("pieces reach across blanks")
        #: kinds of characters, 0 for the blank; words are runs of one kind with the blanks before them, if no piece mixes the kinds
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        self.kinds = np.where(letters | bool({(1, 2), (2, 1)} & crossing), 1, 2).astype(np.uint8)
        self.kinds[ord(" ")] = 0

    def words(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """The words of all texts, none of them empty, with blanks as spaces; how many each text has."""
        joined = (" " + " ".join(texts)).replace(BLANK, " ")
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.kinds[chars]
        begins = np.ones(len(kind), bool)
        begins[1:] = (kind[:-1] != 0) & (kind[1:] != kind[:-1])
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        begins[first[:-1]] = True
        starts = np.append(np.flatnonzero(begins), len(kind))
        if joined.isascii():
            offsets = starts
        else:
            width = np.ones(len(chars) + 1, np.uint8)
            width[0] = 0
            for low in (0x80, 0x800, 0x10000):
                width[1:] += chars >= low
            offsets = np.cumsum(width, dtype=np.int64)[starts]
        found = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(joined.encode()))
        return found, np.diff(np.searchsorted(starts, first))

    def unordered(self) -> set[str]:
        """Pieces that the merges of better scores inside them may leave in three parts or more, and those that share a score.

        All others are ready for their merge once the better ones are done, if ever: so one pass over the edges by score does all merges.
        """
        score = {p: x for p, _, x in self.rows}
        shared = Counter(score.values())

        def parts(p: str) -> int:
            cuts = set(range(len(p) + 1))
            inside = ((i, j) for i in range(len(p)) for j in range(i + 2, len(p) + 1))
            for _, i, j in sorted((-score[p[i:j]], i, j) for i, j in inside if score.get(p[i:j], score[p]) > score[p]):
                between = [k for k in range(i + 1, j) if k in cuts]
                if len(between) == 1 and i in cuts and j in cuts:
                    cuts.remove(between[0])
            return len(cuts) - 1

        return {p for p, x in score.items() if len(p) > 1 and (shared[x] > 1 or parts(p) != 2)}

    def decode(self, ids) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame(pieces(path).rows, "piece string, id int, score double")


def lattice(words: DataFrame, table: DataFrame, longest_piece: int, keys: list[str]) -> DataFrame:
    """(keys, edges): edges (key, id, score) of each word, in order; ``keys`` end with the word."""
    n = F.length("word")
    starts = words.select(*keys, n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    spans = starts.select(*keys, "i", F.explode(F.sequence(F.col("i") + 1, F.least("n", F.col("i") + longest_piece))).alias("j"))
    parts = spans.select(*keys, (F.col("i").cast("long") * STEP + F.col("j")).alias("key"),
                         F.substring("word", F.col("i") + 1, F.col("j") - F.col("i")).alias("piece"))
    edges = parts.join(F.broadcast(table), "piece")  # the vocabulary: a fixed size
    return edges.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("key", "id", "score"))).alias("edges"))


def _fold_viterbi(n: Column) -> Column:
    """Cut places of the best path; a character without an edge of its own costs more than any path of pieces."""
    penalty = -1e12

    def step(acc, j):
        # edges that end at j, and one character for the bytes
        own = F.filter("edges", lambda e: e["key"] % STEP == j)
        ways = F.concat(F.array(F.struct((F.element_at(acc["best"], j) + penalty).alias("score"), (j - 1).alias("from_"))), F.transform(
            own, lambda e: F.struct((F.element_at(acc["best"], (e["key"] / STEP).cast("int") + 1) + e["score"]).alias("score"),
                                    (e["key"] / STEP).cast("int").alias("from_"))))
        top = F.array_max(ways)
        return F.struct(F.array_append(acc["best"], top["score"]).alias("best"), F.array_append(acc["back"], top["from_"]).alias("back"))

    start = F.struct(F.array(F.lit(0.0)).alias("best"), F.array(F.lit(0)).alias("back"))
    back = F.aggregate(F.sequence(F.lit(1), n), start, step)["back"]
    walk = F.aggregate(F.sequence(F.lit(1), n), F.array(n), lambda cuts, _: F.when(
        F.element_at(cuts, 1) > 0, F.array_prepend(cuts, F.element_at(back, F.element_at(cuts, 1) + 1))).otherwise(cuts))
    return walk


def _packed_table(spark: SparkSession, path: str) -> DataFrame:
    """(piece, base): rank of the score and id of each piece, and the empty piece, an edge that every word has."""
    rows = pieces(path).rows
    rank = {x: i for i, x in enumerate(sorted({-x for _, _, x in rows}))}
    if max(len(rank) + 1, *(i for _, i, _ in rows)) >= ODD:
        raise ValueError("too many pieces")
    odd = pieces(path).unordered()
    return spark.createDataFrame([(p, rank[-x] << RANK_AT | (p in odd) * ODD | i) for p, i, x in rows] + [("", len(rank) << RANK_AT)], "piece string, base long")


def _merge_edges(words: DataFrame, path: str, longest: int) -> DataFrame:
    """(word, places, edges, odd): packed edges of each word, best score first, ties to the left, and whether one is marked ODD.

    A longer word has the empty edge only.
    """
    n, i, j = F.length("word"), F.col("i"), F.col("j")
    long_ = n > min(longest, 64)
    starts = words.select("word", "places", F.explode(F.sequence(F.lit(0), F.when(long_, 0).otherwise(n - 1))).alias("i"))
    ends = F.sequence(F.when(i == 0, 0).otherwise(i + 1), F.when(long_, 0).otherwise(F.least(n, i + pieces(path).longest)))
    spans = starts.select("word", "places", "i", F.explode(ends).alias("j")).withColumn("piece", F.substring("word", i + 1, j - i))
    edges = spans.join(F.broadcast(_packed_table(words.sparkSession, path)), "piece").select(  # the vocabulary: a fixed size
        "word", F.when(j == 0, F.col("places")).alias("places"),
        (F.col("base") + F.shiftleft(i.cast("long"), START_AT) + F.shiftleft(j.cast("long"), ID_BITS)).alias("edge"))
    return edges.groupBy("word").agg(F.first("places", ignorenulls=True).alias("places"), F.sort_array(F.collect_list("edge")).alias("edges"),
                                     (F.bit_or("edge").bitwiseAND(ODD) > 0).alias("odd"))


def _start(e: Column) -> Column:
    return F.shiftright(e, START_AT).bitwiseAND((1 << END_BITS) - 1).cast("int")


def _end(e: Column) -> Column:
    return F.shiftright(e, ID_BITS).bitwiseAND((1 << END_BITS) - 1).cast("int")


def _one_pass(n: Column) -> Column:
    """Edges left after all merges, by their places (start, end, id), if the merges follow the order of scores; words of 63 characters at most.

    The cuts are bits: bit k is the place k.  An edge is merged if its ends are cuts, with one cut inside.
    """
    shift = lambda name, x, k: F.call_function(name, x, k)
    one = F.lit(1).cast("long")

    def ends(e: Column) -> Column:
        a = _start(e)
        return F.struct(e.alias("edge"), a.alias("at"), (shift("shiftleft", one, _end(e) - a) + 1).alias("ends"))

    def seen(cuts: Column, e: Column) -> Column:
        return shift("shiftrightunsigned", cuts, e["at"]).bitwiseAND(e["ends"] + e["ends"] - 3)

    def step(cuts: Column, e: Column) -> Column:
        ready = (F.bit_count(seen(cuts, e)) == 3) & (seen(cuts, e).bitwiseAND(e["ends"]) == e["ends"])
        return F.when(ready, cuts.bitwiseAND(F.bitwise_not(shift("shiftleft", e["ends"] - 3, e["at"])))).otherwise(cuts)

    def fold(every: Column) -> Column:
        def finish(cuts: Column) -> Column:
            left = F.filter(every, lambda e: seen(cuts, e) == e["ends"])
            return F.sort_array(F.transform(left, lambda e: e["edge"].bitwiseAND((1 << RANK_AT) - 1)))

        return F.aggregate(F.filter(every, lambda e: e["ends"] > 3), shift("shiftrightunsigned", F.lit(-1).cast("long"), 63 - n), step, finish)

    every = F.transform(F.filter("edges", lambda e: _end(e) > 0), ends)
    # a fold over one element binds the edges, so that they are made once
    return F.aggregate(F.array(every), F.array().cast("array<bigint>"), lambda _, x: fold(x))


def _by_steps(n: Column) -> Column:
    """The same, for any merges and words of 64 characters at most: each step takes the first edge that is ready.

    Here bit k is the place k + 1.
    """
    one = F.lit(1).cast("long")
    bit = lambda k: F.call_function("shiftleft", one, k - 1)
    # the places before k
    below = lambda k: F.when(k > 1, F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), 65 - k)).otherwise(F.lit(0).cast("long"))

    def masks(e: Column) -> Column:
        a, b = _start(e), _end(e)
        inner = below(b).bitwiseAND(F.bitwise_not(below(a + 1)))
        outer = F.when(a > 0, bit(a)).otherwise(F.lit(0).cast("long")).bitwiseOR(F.when(b < n, bit(b)).otherwise(F.lit(0).cast("long")))
        return F.struct(e.alias("edge"), inner.alias("inner"), outer.alias("outer"), (b - a).alias("size"))

    def step(acc: Column, _: Column) -> Column:
        cuts = acc["cuts"]
        ready = F.filter(acc["wide"], lambda e: (F.bit_count(cuts.bitwiseAND(e["inner"])) == 1) & (cuts.bitwiseAND(e["outer"]) == e["outer"]))
        cut = F.coalesce(cuts.bitwiseAND(F.bitwise_not(F.get(ready, F.lit(0))["inner"])), cuts)
        return F.struct(cut.alias("cuts"), acc["wide"].alias("wide"), acc["all"].alias("all"))

    def finish(acc: Column) -> Column:
        cuts = acc["cuts"]
        left = F.filter(acc["all"], lambda e: (cuts.bitwiseAND(e["inner"]) == 0) & (cuts.bitwiseAND(e["outer"]) == e["outer"]))
        return F.sort_array(F.transform(left, lambda e: e["edge"].bitwiseAND((1 << RANK_AT) - 1)))  # start, end, id

    every = F.transform(F.filter("edges", lambda e: _end(e) > 0), masks)
    begin = lambda x: F.struct(below(n).alias("cuts"), F.filter(x, lambda e: e["size"] > 1).alias("wide"), x.alias("all"))
    # a fold over one element binds the edges, so that no step makes them again
    bound = F.aggregate(F.array(F.lit(0)), begin(F.array().cast("array<struct<edge:bigint,inner:bigint,outer:bigint,size:int>>")), lambda acc, _: begin(every))
    steps = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, bound, step, finish)


def _fold_merges(n: Column, first: int, widest: int) -> Column:
    """Ids after all merges of ``edges``; null where they do not cover the word and the model has no bytes."""
    id_ = lambda e: e.bitwiseAND(ODD - 1).cast("int")
    found = F.when((n < 64) & ~F.col("odd"), _one_pass(n)).otherwise(_by_steps(n)) if widest < 60 else _by_steps(n)

    def bytes_(k: Column) -> Column:
        code = F.hex(F.encode(F.substring("word", k + 1, F.lit(1)), "UTF-8"))
        raw = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda q: F.conv(F.substring(code, q, F.lit(2)), 16, 10).cast("int") + first)
        return F.struct(k.alias("at"), raw.alias("ids"))

    def with_bytes(edges: Column) -> Column:
        bare = F.filter(F.sequence(F.lit(0), n - 1), lambda k: ~F.exists(edges, lambda e: (_start(e) <= k) & (k < _end(e))))
        known = F.transform(edges, lambda e: F.struct(_start(e).alias("at"), F.array(id_(e)).alias("ids")))
        return F.flatten(F.sort_array(F.concat(known, F.transform(bare, bytes_)))["ids"])

    def ids(acc: Column) -> Column:
        edges = acc["found"]
        size = F.aggregate(edges, F.lit(0), lambda m, e: m + _end(e) - _start(e))
        rest = with_bytes(edges) if first >= 0 else F.lit(None).cast("array<int>")
        return F.when(size == n, F.transform(edges, id_)).otherwise(rest)

    none = F.array().cast("array<bigint>")
    return F.aggregate(F.array(F.lit(0)), F.struct(none.alias("found")), lambda acc, _: F.struct(found.alias("found")), ids)


def _encode_merges(words: DataFrame, path: str, longest: int = 64) -> DataFrame:
    """(word, places, ids) of rows (word, places), dealt by their words; ids are null where the library is to be asked."""
    p = pieces(path)
    n = F.length("word")
    graph = _merge_edges(words, path, longest)
    ids = _fold_merges(n, p.first_byte if p.first_byte is not None else -1, p.longest)
    return graph.select("word", "places", F.when(n <= min(longest, 64), ids).alias("ids"))


def encode_words(words: DataFrame, path: str, fold: str = "merges") -> DataFrame:
    """(word, ids) of distinct words of 64 characters at most; no shuffle if ``words`` is dealt by them."""
    if fold == "merges":
        return _encode_merges(words.select("word", F.lit(None).cast("array<bigint>").alias("places")), path).select("word", "ids")
    p, spark = pieces(path), words.sparkSession
    first = p.first_byte if p.first_byte is not None else -1
    graph = lattice(words, piece_table(spark, path), p.longest, ["word"])
    ready = words.join(graph, "word", "left") if first < 0 else graph
    df = ready.withColumn("edges", F.coalesce("edges", F.array().cast("array<struct<key:bigint,id:int,score:double>>")))
    df = df.withColumn("keys", F.col("edges.key"))
    df = df.withColumn("cuts", _fold_viterbi(F.length("word")))

    def token(k: Column) -> Column:
        a, b = F.element_at("cuts", k), F.element_at("cuts", k + 1)
        at = F.array_position("keys", a.cast("long") * STEP + b).cast("int")
        code = F.hex(F.encode(F.substring("word", a + 1, b - a), "UTF-8"))
        raw = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda q: F.conv(F.substring(code, q, F.lit(2)), 16, 10).cast("int") + first)
        return F.when(at > 0, F.array(F.element_at(F.col("edges.id"), at))).otherwise(raw)

    return df.select("word", F.flatten(F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), token)).alias("ids"))


def encode(docs: DataFrame, path: str, fold: str = "merges", longest: int = 64, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of whole texts."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    listed = stage(slim.mapInArrow(_block_words(path, block_chars), "block long, base int, words array<string>"), "words")
    digests = {r["block"]: r["words"][0] for r in listed.filter("base < 0").collect()}  # a row for each block
    pairs = listed.filter("base >= 0")
    number = pairs.agg(F.sum(F.size("words"))).first()[0] or 0
    place = F.shiftleft("block", POS_BITS) + F.col("base") + F.col("pos")
    seen = pairs.select("block", "base", F.posexplode("words").alias("pos", "word")).select("word", place.alias("place"))
    # small partitions, so that the edges of one are grouped in memory
    dealt = seen.repartition(max(1, -(-number // WORDS_AT_ONCE)), "word").groupBy("word").agg(F.collect_list("place").alias("places"))
    if fold == "merges":
        known = _encode_merges(dealt, path, longest)
    else:
        known = dealt.join(encode_words(dealt.select("word").filter(F.length("word") <= longest), path, fold), "word", "left")
    packed = known.select("word", "places", "ids").mapInArrow(_packed_ids(path), "block long, pos binary, sizes binary, ids binary, odd binary")
    marked = slim.mapInArrow(_marked(path, block_chars, digests), "block long, doc_id long, marks binary, ids array<int>, round_trip boolean")
    return marked.groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(
        _assemble, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def _packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2 ** 28 as bytes, seven bits in each, the last one of a number below 128; where the numbers end."""
    size = np.ones(len(numbers), np.int64)
    for k in (7, 14, 21):
        size += numbers >> k > 0
    ends = np.cumsum(size)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    out[ends - 1] = numbers & 127
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[ends[more] - 1 - k] = (numbers[more] >> 7 * k) & 127 | 128
    return out, ends


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    size = np.diff(last, prepend=-1)
    out = raw[last].astype(np.int32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= (raw[last[more] - k] & 127).astype(np.int32) << 7 * k
    return out


class _Block:
    """Texts that are cut into words together."""

    def __init__(self):
        self.ids, self.texts, self.counts, self.lists, self.codes, self.chars = [], [], [], [], [], 0

    def add(self, own: Pieces | None, ids: pa.Array, column: pa.Array, keep: bool) -> None:
        texts = column.to_pylist()
        full = [i for i, t in enumerate(texts) if t]
        counts = np.zeros(len(texts), np.int64)
        if own and full:
            found, counts[full] = own.words([texts[i] for i in full])
            found = found.dictionary_encode()
            self.lists.append(found.dictionary)
            self.codes.append(found.indices.to_numpy())
        self.ids.append(ids)
        if keep:
            self.texts.append(column)
        self.counts.append(counts)
        self.chars += sum(map(len, texts))

    def numbered(self) -> tuple[pa.Array, np.ndarray]:
        """Distinct words, the most frequent first, and the number of each word of the texts."""
        both = pa.concat_arrays([pa.array([], pa.string()), *self.lists]).dictionary_encode()
        merged, at = both.indices.to_numpy(), np.cumsum([0] + [len(x) for x in self.lists])
        codes = np.concatenate([np.zeros(0, np.int32)] + [merged[a:b][c] for c, a, b in zip(self.codes, at, at[1:], strict=False)])
        order = np.argsort(-np.bincount(codes, minlength=len(both.dictionary)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return pc.replace_substring(both.dictionary.take(pa.array(order)), " ", BLANK), rank[codes]


def _blocks(path: str | None, batches: Iterable[pa.RecordBatch], block_chars: int, keep: bool = False) -> Iterator[tuple[int, _Block]]:
    """Number and block of the rows (doc_id, text) of a partition, in their order, so copies of a text spread over as many as they fill."""
    own, number, block = path and pieces(path), TaskContext.get().partitionId() << 12, _Block()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a, b in slices(pc.utf8_length(texts).to_pylist(), min(SLICE, block_chars)):
            block.add(own, ids.slice(a, b - a), texts.slice(a, b - a), keep)
            if block.chars >= block_chars:
                yield number, block
                number, block = number + 1, _Block()
    if block.ids:
        yield number, block


def _homed(slim: DataFrame, block_chars: int) -> DataFrame:
    """(home, doc_id, text): the block of each row, to look at."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(None, batches, block_chars, True):
            for ids, texts in zip(block.ids, block.texts, strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number, np.int64)), ids, texts], ["home", "doc_id", "text"])

    return slim.mapInArrow(run, "home long, doc_id long, text string")


def _digest(words: pa.Array) -> str:
    lengths = pc.binary_length(words).to_numpy().tobytes()
    return hashlib.blake2b("".join(words.to_pylist()).encode() + lengths, digest_size=16).hexdigest()


def _block_words(path: str, block_chars: int):
    """Distinct words of each block in lists, by their numbers from ``base`` on; and a digest of them all, at -1."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(path, batches, block_chars):
            words, _ = block.numbered()
            yield pa.RecordBatch.from_pylist([{"block": number, "base": -1, "words": [_digest(words)]}], _LISTS)
            for a in range(0, len(words), 20_000):
                part = words.slice(a, 20_000)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([a], pa.int32()),
                                                  pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)], schema=_LISTS)

    return run


_LISTS = pa.schema([("block", pa.int64()), ("base", pa.int32()), ("words", pa.list_(pa.string()))])
def _marked(path: str, block_chars: int, digests: dict[int, str]):
    """The numbers of the words of each text; where the block has not the words it had, the ids of the text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for number, block in _blocks(path, batches, block_chars, True):
            words, marks = block.numbered()
            as_before = _digest(words) == digests.get(number)
            data, ends = _packed(marks)
            first = np.append(0, ends)[np.cumsum([0, *np.concatenate(block.counts)])]
            a = 0
            for ids, texts in zip(block.ids, block.texts, strict=True):
                n = len(ids)
                home, rows = pa.array(np.full(n, number, np.int64)), [ids, *[pa.nulls(n, t) for t in (pa.binary(), pa.list_(pa.int32()), pa.bool_())]]
                if as_before:
                    part, own_first = data[first[a]:first[a + n]].tobytes(), first[a:a + n + 1] - first[a]
                    rows[1] = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(own_first.astype(np.int32)), pa.py_buffer(part)])
                else:
                    found = [own.sp.encode(t, num_threads=1) for t in texts.to_pylist()]
                    rows[2] = pa.array(found, pa.list_(pa.int32()))
                    rows[3] = pa.array([own.decode(x) == t.replace(BLANK, " ") for x, t in zip(found, texts.to_pylist(), strict=True)])
                a += n
                yield pa.RecordBatch.from_arrays([home, *rows], ["block", "doc_id", "marks", "ids", "round_trip"])

    return run


def _packed_ids(path: str):
    """The words of a batch by their blocks: numbers in the block, how many ids, the ids, and the numbers of words that do not come back from their ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path)
        for batch in batches:
            words, lists = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            coded = [_rest(own, w) if x is None else np.asarray(x, np.int64) for w, x in zip(words, lists, strict=True)]
            odd = np.array([b"".join(map(own.surface.__getitem__, x.tolist())) != w.replace(BLANK, " ").encode() for w, x in zip(words, coded, strict=True)], bool)
            sizes = np.array([len(x) for x in coded], np.int64)
            flat, first = np.concatenate([np.zeros(0, np.int64), *coded]), np.cumsum(sizes) - sizes
            places = batch.column(1)
            word = np.repeat(np.arange(len(words)), np.diff(places.offsets.to_numpy()))
            places = places.flatten().to_numpy()
            order = np.argsort(places)
            places, word = places[order], word[order]
            blocks, pos = places >> POS_BITS, places & ((1 << POS_BITS) - 1)
            cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else np.zeros(0, np.int64)
            out = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(blocks)], strict=True):
                w = word[a:b]
                ids = flat[_ragged(first[w], sizes[w])]
                out.append([_packed(x)[0].tobytes() for x in (np.diff(pos[a:b], prepend=0), sizes[w], ids, pos[a:b][odd[w]])])
            yield pa.RecordBatch.from_arrays([pa.array(blocks[cuts]), *(pa.array([x[k] for x in out], pa.binary()) for k in range(4))],
                                             ["block", "pos", "sizes", "ids", "odd"])

    return run


def _ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each, as many as its size."""
    ends = np.cumsum(sizes)
    return np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _assemble(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Rows of a block with the ids of their words."""
    pos, sizes, odd = ([_unpacked(x) for x in right.column(c).to_pylist()] for c in ("pos", "sizes", "odd"))
    none = np.zeros(0, np.int32)
    pos = np.concatenate([none, *map(np.cumsum, pos)])
    at = np.empty(len(pos), np.int64)
    at[pos] = np.arange(len(pos))
    sizes, flat = np.concatenate([none, *sizes]).astype(np.int64), np.concatenate([none, *(_unpacked(x) for x in right.column("ids").to_pylist())])
    first = (np.cumsum(sizes) - sizes)[at]
    sizes, bad = sizes[at], np.zeros(len(pos), bool)
    bad[np.concatenate([none, *odd])] = True
    del right, at, pos
    out = []
    for batch in left.to_batches(max_chunksize=500):
        ids, n, good = [], [], []
        for marks, own, same in zip(*(batch.column(c).to_pylist() for c in ("marks", "ids", "round_trip")), strict=True):
            if marks is not None:
                marks = _unpacked(marks)
                own, same = flat[_ragged(first[marks], sizes[marks])], not bad[marks].any()
            ids.append(np.asarray(own, np.int32))
            n.append(len(ids[-1]))
            good.append(same)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(np.concatenate([none, *ids])))
        out.append(pa.table({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()), "ids": lists, "round_trip": pa.array(good, pa.bool_())}))
    return pa.concat_tables(out) if out else pa.schema(_ROW).empty_table()


_ROW = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())]


def _rest(own: Pieces, word: str) -> np.ndarray:
    """Ids of a word outside the lattice: very long, or without any edge."""
    if word[0] == BLANK:
        return np.asarray(own.sp.encode(word[1:].replace(BLANK, " "), num_threads=1), np.int32)
    return np.asarray(own.sp.encode("\n" + word, num_threads=1)[2:], np.int32)  # without the blank and the line end in front


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), by a join to the piece table."""
    p, spark = pieces(path), encoded.sparkSession
    table = spark.createDataFrame([(i, b) for i, b in enumerate(p.surface)], "id int, part binary")
    numbered = encoded.select("doc_id", "ids").withColumn("row", F.monotonically_increasing_id())
    rows = numbered.select("row", "doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    joined = rows.join(F.broadcast(table), "id", "left").groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("parts"))
    hexed = F.array_join(F.transform("parts", lambda x: F.coalesce(F.hex(x["part"]), F.lit(""))), "")
    text = F.unhex(hexed).cast("string")
    return joined.select("doc_id", F.when(text.startswith(" "), F.substring(text, 2, F.length(text))).otherwise(text).alias("text"))
