"""Benchmark decontamination with a distributed positional inverted index.

The index holds postings (term, doc_id, version, pos) of the training texts in the shared folder; ``version`` is a hash of the text
and keeps rows apart that repeat a doc_id.  A query phrase is found by intersecting
offset-adjusted lists: the list of its rarest term proposes starts, the lists of its next rarest terms must hold the
term at the right distance, and what is left is compared with the text word by word.  ``proximity`` finds
two terms within a distance from the same lists.

Terms are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.  Index keys are lower-cased word by word by all of
Unicode's rules, which never parts equal words (in a whole text a sigma would follow its neighbours); the comparison at the end uses the words themselves.  The lists a
phrase set can ask for are known beforehand (a few rarest terms for each window), so only those are stored.  Texts are cut into words once:
counts, postings and numbers of words come from the staged lists of terms.

Null and empty texts have no words; documents without words have 0 hits.  A benchmark row without text
has no windows, one without item_id hits words but is not listed.  Rows that repeat a doc_id have a row each, judged by
their own text.  Texts are read whole, however long.  Terms of equal rarity are taken in the order of their bytes, which changes no result.
Columns other than doc_id, text, item_id are not read.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import stage
from .common import fold_ascii, small_side

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same words before lower-casing
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text):
    return F.regexp_extract_all(fold_ascii(text), F.lit(WORD), F.lit(0))


def raw_words(text):
    return F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0))


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def windows(benchmark: DataFrame, size: int = 13) -> DataFrame:
    """(item_id, phrase): distinct runs of ``size`` words; a shorter item is one phrase."""
    listed = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1))
    return listed.select("item_id", F.explode(starts).alias("s"), "w").select("item_id", F.slice("w", F.col("s"), size).alias("phrase")).distinct()


def term_lists(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, version, terms): the terms of each row in order, so that its text is cut into words once."""
    return stage(_own(docs).select("doc_id", F.xxhash64("text").alias("version"), F.transform(raw_words("text"), F.lower).alias("terms")), "terms")


def term_counts(lists: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): occurrences in all ``term_lists`` of the terms in ``vocabulary``."""
    tokens = lists.select(F.explode("terms").alias("term"))
    return tokens.join(small_side(vocabulary), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Staged postings (term, doc_id, version, pos), of all terms or of those in ``terms``."""
    return _postings(term_lists(docs), terms)


def _postings(lists: DataFrame, terms: DataFrame | None) -> DataFrame:
    tokens = lists.select("doc_id", "version", F.posexplode("terms").alias("pos", "term"))
    if terms is not None:
        tokens = tokens.join(small_side(terms), "term", "left_semi")
    return stage(tokens.select("term", "doc_id", "version", "pos"), "postings")


def anchors(phrases: DataFrame, counts: DataFrame, keys: int = 3) -> DataFrame:
    """(phrase_id, rank, term, at): the ``keys`` rarest places of each phrase; ranks from 1, ties by place.

    A phrase with a term that no document has is left out: it cannot occur.
    """
    placed = phrases.select("phrase_id", F.posexplode("phrase").alias("at", "word")).select(
        "phrase_id", "at", F.lower("word").alias("term"))
    known = placed.join(counts, "term", "left")
    whole = known.groupBy("phrase_id").agg(F.count("*").alias("long"), F.count("n").alias("seen")).filter("long = seen")
    order = Window.partitionBy("phrase_id").orderBy("n", "at")
    ranked = known.join(whole.select("phrase_id"), "phrase_id", "left_semi").withColumn("rank", F.row_number().over(order))
    return stage(ranked.filter(F.col("rank") <= keys).select("phrase_id", "rank", "term", "at"), "anchors")


def candidate_starts(index: DataFrame, keys: DataFrame, ranks: int) -> DataFrame:
    """(phrase_id, doc_id, version, start) where the rarest terms of a phrase stand at its distances."""
    first = small_side(stage(keys.filter("rank = 1"), "rarest"))
    here = index.join(first, "term").select("phrase_id", "doc_id", "version", (F.col("pos") - F.col("at")).alias("start")).filter("start >= 0")
    if ranks == 1:
        return here
    # the other lists, adjusted to the start they would belong to; short phrases have fewer of them
    more = keys.filter("rank > 1")
    needed = small_side(stage(more.groupBy("phrase_id").agg(F.count("*").alias("needed")), "needed"))
    wanted = here.join(small_side(stage(more.groupBy("phrase_id").agg(
        F.collect_list(F.struct("rank", "term", "at")).alias("others")), "others")), "phrase_id", "left")
    asked = wanted.select("phrase_id", "doc_id", "version", "start", F.explode_outer("others").alias("o")).select(
        "phrase_id", "doc_id", "version", "start", "o.rank", "o.term", (F.col("start") + F.col("o.at")).alias("pos"))
    alone = asked.filter("rank is null").select("phrase_id", "doc_id", "version", "start")
    held = asked.filter("rank is not null").join(
        index, (asked.term == index.term) & asked.doc_id.eqNullSafe(index.doc_id) & (asked.version == index.version) & (asked.pos == index.pos),
        "left_semi")
    full = held.groupBy("phrase_id", "doc_id", "version", "start").agg(F.countDistinct("rank").alias("found")).join(
        needed, "phrase_id").filter("found = needed")
    return full.select("phrase_id", "doc_id", "version", "start").unionByName(alone)


def phrase_matches(docs: DataFrame, phrases: DataFrame, keys: int = 3, lists: DataFrame | None = None) -> DataFrame:
    """(phrase_id, doc_id, version, start, length): every occurrence of ``phrases`` (phrase_id, phrase) in the texts.

    ``lists`` are the ``term_lists`` of the documents, if the caller has them.
    """
    lists = term_lists(docs) if lists is None else lists
    vocabulary = stage(phrases.select(F.explode("phrase").alias("word")).select(F.lower("word").alias("term")).distinct(), "vocabulary")
    counts = stage(term_counts(lists, vocabulary), "counts")
    chosen = anchors(phrases, counts, keys)
    index = _postings(lists, stage(chosen.select("term").distinct(), "terms"))
    starts = stage(candidate_starts(index, chosen, keys).distinct(), "starts")
    met = small_side(stage(starts.select("doc_id").distinct(), "met"))
    texts = _own(docs)
    texts = texts.join(met, texts.doc_id.eqNullSafe(met.doc_id), "left_semi")
    texts = stage(texts.select("doc_id", F.xxhash64("text").alias("version"), words("text").alias("w")).dropDuplicates(["doc_id", "version"]), "texts")
    claims = starts.join(small_side(stage(phrases, "phrases")), "phrase_id").alias("c")
    held = claims.join(texts.alias("t"), F.col("c.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("c.version") == F.col("t.version")))
    return held.filter(F.slice("w", F.col("start") + 1, F.size("phrase")) == F.col("phrase")).select(
        "phrase_id", "c.doc_id", "c.version", "start", F.size("phrase").alias("length"))


def proximity(index: DataFrame, first: str, second: str, distance: int) -> DataFrame:
    """(doc_id, version, pos, other): places of two indexed terms at most ``distance`` words apart, in any order.

    Each place of the first term meets only the places of the second in its own or a neighbouring block of words.
    """
    block = lambda c: F.floor(F.col(c) / distance)
    a = index.filter(F.col("term") == first).select("doc_id", "version", "pos", F.explode(F.array(*[block("pos") + k for k in (-1, 0, 1)])).alias("block"))
    b = index.filter(F.col("term") == second).select(F.col("doc_id").alias("d"), F.col("version").alias("v"), F.col("pos").alias("other"),
                                                     F.floor(F.col("pos") / distance).alias("other_block"))
    near = a.join(b, a.doc_id.eqNullSafe(b.d) & (a.version == b.v) & (a.block == b.other_block))
    return near.filter((F.abs(F.col("pos") - F.col("other")) <= distance) & (F.col("pos") != F.col("other"))).select(
        "doc_id", "version", "pos", "other")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20, keys: int = 3) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``."""
    listed = stage(windows(benchmark, size), "windows")
    phrases = stage(listed.groupBy("phrase").agg(F.min("item_id").alias("one")).select(
        F.sha2(F.concat_ws(" ", "phrase"), 256).alias("phrase_id"), "phrase"), "phrases")
    lists = term_lists(docs)
    found = stage(phrase_matches(docs, phrases, keys, lists), "found")

    # words inside any match: starts in order, each adds what reaches beyond all before it
    reach = found.groupBy("doc_id", "version", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("doc_id", "version").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hits = reach.withColumn("fresh", fresh).groupBy("doc_id", "version").agg(F.sum("fresh").alias("n_hit"))

    named = listed.select(F.sha2(F.concat_ws(" ", "phrase"), 256).alias("phrase_id"), "item_id").filter("item_id is not null")
    items = found.select("doc_id", "version", "phrase_id").distinct().join(small_side(stage(named, "named")), "phrase_id").groupBy(
        "doc_id", "version").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    judged = hits.join(items, hits.doc_id.eqNullSafe(items.doc_id) & (hits.version == items.version), "left").select(
        hits.doc_id.alias("d"), hits.version.alias("v"), "n_hit", "items")

    rows = lists.select("doc_id", "version", F.size("terms").cast("bigint").alias("n_words"))
    out = rows.join(judged, rows.doc_id.eqNullSafe(F.col("d")) & (rows.version == F.col("v")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    listed_items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed_items).cast("bigint").alias("n_items"),
                      F.sha2(F.concat_ws(",", listed_items), 256).alias("items_sha256"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"), "version")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """The documents, all their columns, that are not contaminated."""
    bad = stage(contamination(docs, benchmark, size, share).filter("contaminated").select(
        F.col("doc_id").alias("_d"), F.col("version").alias("_v")).distinct(), "contaminated")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_d")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_v"))
    return docs.join(small_side(bad), same, "left_anti")
