"""Corpus jobs over a text table (``doc_id``, ``text``, ``lang``, ``source``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import strings, text
from ..functions.numbers import count_if
from ..operators.simjoin import jaccard_join
from ..session import stage


def corpus_sentiment(docs: DataFrame, variant: str = "v1") -> DataFrame:
    build = text.sentiment_v1 if variant == "v1" else text.sentiment_v2
    return docs.select("doc_id", "lang", F.expr(build("text")).alias("sentiment"))


def sentiment_by_language(docs: DataFrame, variant: str = "v1") -> DataFrame:
    return corpus_sentiment(docs, variant).groupBy("lang", "sentiment").agg(F.count("*").alias("documents"))


def corpus_keywords(docs: DataFrame, variant: str = "v1", top: int = 5) -> DataFrame:
    """Top words per document, ties by first appearance; '' without words."""
    words = docs.select("doc_id", F.posexplode(F.expr(text.keyword_tokens("text", variant))).alias("pos", "word"))
    counts = words.groupBy("doc_id", "word").agg(F.count("*").alias("freq"), F.min("pos").alias("first_pos"))
    score = F.col("freq") * F.length("word") if variant == "v1" else F.col("freq")
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "first_pos")
    best = counts.withColumn("score", score).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    # at most ``top`` words per document are gathered
    lists = best.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("picked"))
    lists = lists.select("doc_id", F.array_join("picked.word", ",").alias("keywords"))
    return docs.select("doc_id").join(lists, "doc_id", "left").withColumn("keywords", F.coalesce("keywords", F.lit("")))


def next_document_pairs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("doc_a"), (F.col("doc_id") + 1).alias("doc_b"))


def text_similarity_pairs(docs: DataFrame, pairs: DataFrame, variant: str = "v1") -> DataFrame:
    """Score of each given pair; pairs naming an unknown document are left out."""
    if variant == "v1":
        sets = docs.select("doc_id", F.expr(f"array_distinct({text.tokens('text')})").alias("ws"))
        a = sets.select(F.col("doc_id").alias("doc_a"), F.col("ws").alias("wa"))
        b = sets.select(F.col("doc_id").alias("doc_b"), F.col("ws").alias("wb"))
        both = F.size(F.array_intersect("wa", "wb")).cast("double")
        score = F.try_divide(both, F.size("wa") + F.size("wb") - both)
        return pairs.join(a, "doc_a").join(b, "doc_b").select(
            "doc_a", "doc_b", F.coalesce(score, F.lit(0.0)).alias("similarity"))
    # one row of word counts a document; texts under the same id count as one
    whole = docs.groupBy("doc_id").agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    counts = whole.select("doc_id", F.expr(text.word_counts(text.tokens("text"))).alias("ws")).withColumn(
        "sq", F.expr(text.count_norm("ws")))
    counts = stage(counts, "word_counts")
    side = lambda s: counts.select(F.col("doc_id").alias(f"doc_{s}"), F.col("ws").alias(f"w{s}"), F.col("sq").alias(f"q{s}"))
    # a pair given several times is scored once, each time with all its rows
    given = pairs.groupBy("doc_a", "doc_b").agg(F.count("*").alias("times"))
    score = F.try_divide((F.expr(text.count_dot("wa", "wb")) * F.col("times")).cast("double"),
                         F.sqrt(F.col("qa").cast("double")) * F.sqrt(F.col("qb").cast("double")))
    return given.join(side("a"), "doc_a").join(side("b"), "doc_b").select(
        "doc_a", "doc_b", F.coalesce(F.round(score, 4), F.lit(0.0)).alias("similarity"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("copy")).drop("copy")


def text_similarity_join(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    return jaccard_join(docs.select("doc_id", "text"), "doc_id", text.tokens("text"), threshold)


def corpus_word_count(docs: DataFrame, variant: str = "v1") -> DataFrame:
    return docs.select("doc_id", F.expr(text.word_count("text", variant)).alias("word_count"))


def detect_language(docs: DataFrame, variant: str = "v1") -> DataFrame:
    build = text.language_v1 if variant == "v1" else text.language_v2
    return docs.select("doc_id", "lang", F.expr(build("text")).alias("language"))


def corpus_language_profile(docs: DataFrame, variant: str = "v1") -> DataFrame:
    return detect_language(docs, variant).groupBy("lang", "language").agg(F.count("*").alias("documents"))


def corpus_clean(docs: DataFrame, mode: str = "all", variant: str = "v1") -> DataFrame:
    cleaned = docs.select("doc_id", "source", "text", F.expr(text.clean_text("text", mode, variant)).alias("clean_text"))
    return cleaned.select("doc_id", "source", "clean_text", (F.col("clean_text") != F.col("text")).alias("changed"))


def clean_audit(docs: DataFrame, variant: str = "v1") -> DataFrame:
    """Changed rows and removed characters per mode, from one scan."""
    modes = list(text.CLEAN_MODES[variant])
    wide = docs.select("source", "text", *[F.expr(text.clean_text("text", m, variant)).alias(f"c_{m}") for m in modes])
    per_mode = wide.groupBy("source").agg(*[
        F.struct(F.lit(m).alias("mode"), count_if(F.col(f"c_{m}") != F.col("text")).alias("changed_rows"),
                 F.sum(F.length("text") - F.length(f"c_{m}")).alias("removed_chars")).alias(m) for m in modes])
    return per_mode.select("source", F.explode(F.array(*modes)).alias("r")).select("source", "r.*")


def name_standardize(table: DataFrame, key: str, name: str, variant: str = "v1") -> DataFrame:
    title = "clean" if variant == "v1" else "title_case"
    modes = {"title": title, "plain": "remove_special", "slug": "slug", "initials": "initials"}
    return table.select(key, *[strings.mode_column(name, m, variant).alias(f"name_{k}") for k, m in modes.items()])


def pii_mask(table: DataFrame, key: str, group: str, email: str = "email", phone: str = "phone",
             variant: str = "v1") -> DataFrame:
    masked_phone = strings.mode_column(phone, "mask_phone", "v1") if variant == "v1" else F.col(phone)
    return table.select(key, group, F.col(email).alias("_e"), F.col(phone).alias("_p"),
                        strings.mode_column(email, "mask_email", variant).alias("masked_email"),
                        masked_phone.alias("masked_phone"),
                        ).withColumn("email_masked", F.coalesce(F.col("masked_email") != F.col("_e"), F.lit(False))
                        ).withColumn("phone_masked", F.coalesce(F.col("masked_phone") != F.col("_p"), F.lit(False))
                        ).drop("_e", "_p")


def pii_mask_counts(masked: DataFrame, group: str) -> DataFrame:
    return masked.groupBy(group).agg(
        F.count("*").alias("total_rows"), count_if(F.col("email_masked")).alias("masked_emails"),
        count_if(F.col("phone_masked")).alias("masked_phones"))


def mask_runs(column: str, pattern: str, masked: str) -> str:
    """Text with ``masked`` (of ``h``) in the place of each match; nothing else changes."""
    p = strings.lit(pattern)
    return (f"array_join(zip_with(split({column}, {p}, -1), concat(regexp_extract_all({column}, {p}, 0), array('')), "
            f"(rest, h) -> concat(rest, if(h = '', '', {masked}))), '')")


def mask_text(docs: DataFrame, variant: str = "v1") -> DataFrame:
    """Mask every address and phone number inside a text, whatever stands next to it.

    Phone numbers are masked as in v1, the only published form.
    """
    mails = mask_runs("text", strings.EMAIL_PATTERN.strip("^$"), strings.mode_sql("h", "mask_email", variant))
    # the digits behind a number belong to it, or they would make another with the four that stay
    phones = mask_runs("masked_text", strings.PHONE_PATTERN + "[0-9]*", strings.mode_sql("h", "mask_phone", "v1"))
    return docs.select("doc_id", "text", F.expr(mails).alias("masked_text")).withColumn("masked_text", F.expr(phones)).select(
        "doc_id", "masked_text", (F.col("masked_text") != F.col("text")).alias("changed"))


def unmasked_left(masked: DataFrame, column: str = "masked_text") -> DataFrame:
    """Addresses and phone numbers still in the texts."""
    n = lambda p: F.coalesce(F.sum(F.size(F.regexp_extract_all(column, F.lit(p), F.lit(0)))), F.lit(0)).cast("bigint")
    return masked.agg(n(strings.EMAIL_PATTERN.strip("^$")).alias("emails_left"), n(strings.PHONE_PATTERN).alias("phones_left"))


def contact_validation(table: DataFrame, group: str, email: str = "email", phone: str = "phone") -> DataFrame:
    mail, tel = F.expr(strings.is_email(email)), F.expr(strings.is_phone(phone))
    return table.groupBy(group).agg(
        count_if(mail).alias("valid_emails"), count_if(~mail).alias("invalid_emails"),
        count_if(F.col(email).isNull()).alias("missing_emails"),
        count_if(tel).alias("valid_phones"), count_if(~tel).alias("invalid_phones"),
        count_if(F.col(phone).isNull()).alias("missing_phones"))


def text_shape(table: DataFrame, key: str, column: str, variant: str = "v1") -> DataFrame:
    wanted = ["extract_numbers", "reverse", "word_count"]
    if variant == "v1":
        wanted += ["extract_letters", "upper", "lower", "char_count"]
    return table.select(key, *[strings.mode_column(column, m, variant).alias(m) for m in wanted])


def text_shape_summary(table: DataFrame, column: str, group: str) -> DataFrame:
    words = strings.mode_column(column, "word_count").cast("bigint")
    chars = strings.mode_column(column, "char_count").cast("bigint")
    digits = F.coalesce(F.length(strings.mode_column(column, "extract_numbers")), F.lit(0))
    return table.groupBy(group).agg(
        F.count("*").alias("documents"), F.sum(words).alias("words"), F.sum(chars).alias("chars"),
        F.max(chars).alias("longest"), F.sum(digits).alias("digits"),
        F.sum(F.length(strings.mode_column(column, "extract_letters"))).alias("letters"))
