"""The string and text functions as Spark SQL functions.

They are SQL-bodied temporary functions, which the optimizer inlines.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import strings, text


def _define(spark: SparkSession, name: str, args: str, returns: str, body: str) -> None:
    spark.sql(f"create or replace temporary function {name}({args}) returns {returns} return {body}")


def register_string_utils(spark: SparkSession, variant: str = "v1", name: str = "string_utils") -> None:
    """``string_utils(txt, mode)``; an unknown mode returns the input (v1) or title case (v2)."""
    modes = strings.MODES[variant]
    default = "clean" if variant == "v1" else "title_case"
    arms = " ".join(f"when '{m}' then {build('txt')}" for m, build in modes.items())
    fallback = "txt" if variant == "v1" else modes[default]("txt")
    body = (f"case when txt is null then null else "
            f"case lower(coalesce(mode, '{default}')) {arms} else {fallback} end end")
    _define(spark, name, f"txt string, mode string default '{default}'", "string", body)


def register_text_functions(spark: SparkSession, variant: str = "v1", prefix: str = "text_") -> None:
    sentiment = text.sentiment_v1 if variant == "v1" else text.sentiment_v2
    similarity = text.similarity_v1 if variant == "v1" else text.similarity_v2
    language = text.language_v1 if variant == "v1" else text.language_v2
    _define(spark, f"{prefix}sentiment", "txt string", "string", sentiment("txt"))
    if variant == "v1":
        _define(spark, f"{prefix}keywords", "txt string", "string", text.keywords("txt", "v1"))
    else:
        _define(spark, f"{prefix}keywords", "txt string, top_n bigint", "string",
                text.keywords("txt", "v2", "coalesce(nullif(top_n, 0), 5)"))
    _define(spark, f"{prefix}similarity", "txt1 string, txt2 string", "double", similarity("txt1", "txt2"))
    _define(spark, f"{prefix}word_count", "txt string", "bigint", text.word_count("txt", variant))
    _define(spark, f"{prefix}language_detect", "txt string", "string", language("txt"))
    arms = " ".join(f"when '{m}' then {build('txt')}" for m, build in text.CLEAN_MODES[variant].items())
    if variant == "v1":
        body = f"case mode {arms} else txt end"
    else:
        other = text._squeeze("txt")
        body = f"case lower(coalesce(nullif(mode, ''), 'all')) {arms} else {other} end"
    _define(spark, f"{prefix}clean", "txt string, mode string", "string", body)
