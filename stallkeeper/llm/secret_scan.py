"""Secret scan: fixed patterns, and a randomness battery for strings that no pattern names.

Base spans are the matches of three patterns.  Further candidates are runs of 16 or more characters of the usual encodings.
For each the encoding is inferred (hex, base32, upper or lower base36, base64) and its code values are tested for
* a uniform alphabet (chi-squared, with the exact moments of short strings),
* independent runs above and below the middle of the alphabet,
* no correlation between neighbours.
A candidate must be consistent with randomness in all three (Bonferroni), and must be unlike text: runs of text
seldom change between letter cases and digits, so the chance of its changes under the corpus's own rate, by Chernoff's bound,
is its p-value.  Within each band of lengths, p-values go through Benjamini and Hochberg's step-up procedure over all
candidates of the corpus, on a histogram of their logarithms, so that long strings do not vouch for short ones.

Null text is empty.  Positions are code points, the end exclusive.  Rows that repeat a doc_id are scanned each by its
own text; equal rows get equal results.  Texts are scanned whole; a text with very many matches costs their square.  Columns other than doc_id and text are not read.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import cut_out, small_side

# fixed values: the patterns of the base scan, in the order in which kinds are listed
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")

RUN = r"[A-Za-z0-9+/_-]{16,}"
BIN = 0.1  # width of a bin of -log10 p
TOP = 3000
BANDS = (16, 24, 32, 48, 64, 128)

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = {
    "hex": _DIGIT + "abcdef",
    "base32": _UPPER + "234567",
    "upper36": _DIGIT + _UPPER,
    "lower36": _DIGIT + _LOWER,
    "base64": _UPPER + _LOWER + _DIGIT + "+/",
}


def _matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """array<(start, end, value)> of the leftmost matches; the gaps before them give the places."""
    lead = F.lit(rf"\G(?s)(.*?)({pattern})")  # \G: the tail without a match is read once
    found = F.arrays_zip(
        F.regexp_extract_all(text, lead, F.lit(1)).alias("gap"), F.regexp_extract_all(text, lead, F.lit(2)).alias("hit"),
        F.regexp_extract_all(text, lead, F.lit(2 + value_group)).alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    step = lambda acc, x: F.struct(
        (acc["pos"] + F.length(x["gap"]) + F.length(x["hit"])).alias("pos"),
        F.array_append(acc["out"], F.struct(
            (acc["pos"] + F.length(x["gap"])).alias("start"),
            (acc["pos"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"), x["value"].alias("value"))).alias("out"))
    return F.aggregate(found, F.struct(F.lit(0).alias("pos"), empty.alias("out")), step)["out"]


def _when(cond: Column, spans: Column) -> Column:
    return F.when(cond, spans).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _spans(text: Column) -> dict[str, Column]:
    """Spans of each kind; cheap tests keep the patterns away from most texts."""
    low = F.lower(text)
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api_key") | low.contains("apikey")
    return {
        "assign": F.filter(_when(named, _matches(text, ASSIGN, 2)), lambda s: F.length(s["value"]) >= 8),
        "access": F.filter(_when(text.contains("AKIA"), _matches(text, ACCESS)), lambda s: s["end"] - s["start"] >= 16),
        # shorter runs are dropped anyway and do not shift the others
        "hex": _when(text.rlike("[0-9a-f]{32}"), _matches(text, "[0-9a-f]{32,}")),
        "run": _when(text.rlike(RUN), _matches(text, RUN)),
    }


def _scanned(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, version, base, runs, changes, pairs) for each row."""
    text = F.coalesce("text", F.lit(""))
    found = _spans(F.col("text"))
    tag = lambda k, n: F.transform(k, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end")))
    tagged = [tag(k, n) for n, k in enumerate(KINDS[:3])]
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    spans = own.select("doc_id", F.xxhash64("text").alias("version"), *[v.alias(k) for k, v in found.items()])
    plain = F.filter("run", lambda s: ~(s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")))
    return stage(spans.select(
        "doc_id", "version", F.array_sort(F.concat(*tagged)).alias("base"),
        F.filter("run", lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")).alias("runs"),
        F.aggregate(plain, F.lit(0).cast("bigint"), lambda n, s: n + _changes(s["value"])).alias("changes"),
        F.aggregate(plain, F.lit(0).cast("bigint"), lambda n, s: n + F.length(s["value"]) - 1).alias("pairs")), "scanned")


def _changes(value: Column) -> Column:
    """Neighbours of different class: lower case, upper case, digit, sign."""
    blocks = F.size(F.regexp_extract_all(value, F.lit(r"[a-z]+|[A-Z]+|[0-9]+|[+/_-]+"), F.lit(0)))
    return blocks.cast("bigint") - 1


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, to about 1e-4 and with the right decay."""
    return 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))


def battery(runs: DataFrame) -> DataFrame:
    """Adds encoding, p_uniform, p_runs, p_serial and p_random to rows with a ``value`` of letters and digits."""
    v = F.col("value")
    encoding = (F.when(v.rlike("^[0-9a-f]+$") | v.rlike("^[0-9A-F]+$"), "hex").when(v.rlike("^[A-Z2-7]+$"), "base32")
                .when(v.rlike("^[A-Z0-9]+$"), "upper36").when(v.rlike("^[a-z0-9]+$"), "lower36").otherwise("base64"))
    alphabet = F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv])
    df = runs.withColumn("encoding", encoding).withColumn("alphabet", alphabet[F.col("encoding")])
    plain = F.when(F.col("encoding") == "hex", F.lower("value")).otherwise(F.translate("value", "-_", "+/"))
    df = df.withColumn("chars", F.regexp_extract_all(plain, F.lit("."), F.lit(0))).withColumn("k", F.length("alphabet").cast("double"))
    df = df.withColumn("codes", F.transform("chars", lambda c: (F.call_function("instr", F.col("alphabet"), c) - 1).cast("double")))
    df = df.withColumn("n", F.size("codes").cast("double"))
    squares = F.aggregate(F.array_distinct("codes"), F.lit(0.0), lambda s, c: s + F.pow(F.size(F.filter("codes", lambda x: x == c)).cast("double"), F.lit(2.0)))
    df = df.withColumn("chi", squares * F.col("k") / F.col("n") - F.col("n"))
    df = df.withColumn("z_uniform", (F.col("chi") - (F.col("k") - 1)) / F.sqrt(2 * (F.col("k") - 1) * (1 - 1 / F.col("n"))))

    upper = F.transform("codes", lambda c: c >= F.col("k") / 2)
    steps = lambda a: F.zip_with(F.slice(a, 1, F.size(a) - 1), F.slice(a, 2, F.size(a) - 1), lambda x, y: F.when(x != y, 1.0).otherwise(0.0))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    df = df.withColumn("high", upper).withColumn("n1", F.size(F.filter("high", lambda x: x)).cast("double"))
    df = df.withColumn("mu", 2 * F.col("n1") * (F.col("n") - F.col("n1")) / F.col("n") + 1)
    spread = F.sqrt((F.col("mu") - 1) * (F.col("mu") - 2) / (F.col("n") - 1))
    df = df.withColumn("z_runs", F.when((F.col("mu") > 2), (1 + total(steps(F.col("high"))) - F.col("mu")) / spread).otherwise(F.lit(99.0)))

    df = df.withColumn("mean", total(F.col("codes")) / F.col("n"))
    df = df.withColumn("dev", F.transform("codes", lambda c: c - F.col("mean")))
    power = total(F.transform("dev", lambda d: d * d))
    lagged = total(F.zip_with(F.slice("dev", 1, F.size("dev") - 1), F.slice("dev", 2, F.size("dev") - 1), lambda a, b: a * b))
    df = df.withColumn("z_serial", F.when(power > 0, (lagged / power + 1 / F.col("n")) * F.sqrt("n")).otherwise(F.lit(99.0)))
    two = lambda z: F.least(F.lit(1.0), 2 * _tail(F.abs(z)))
    df = df.withColumn("p_uniform", _tail(F.col("z_uniform"))).withColumn("p_runs", two(F.col("z_runs"))).withColumn("p_serial", two(F.col("z_serial")))
    return df.withColumn("p_random", F.least(F.lit(1.0), 3 * F.least("p_uniform", "p_runs", "p_serial"))).drop(
        "alphabet", "chars", "codes", "chi", "high", "n1", "mu", "mean", "dev", "k", "n", "z_uniform", "z_runs", "z_serial")


def _band(length: Column) -> Column:
    out = F.lit(0)
    for b in BANDS:
        out = out + F.when(length >= b, 1).otherwise(0)
    return out


def random_runs(scanned: DataFrame, alpha: float = 0.001, rate: float = 0.01) -> DataFrame:
    """(doc_id, version, start, end, value, encoding, p_random, p_text): discoveries at a false-discovery rate of ``rate``."""
    runs = scanned.select("doc_id", "version", F.explode("runs").alias("r")).select("doc_id", "version", "r.start", "r.end", "r.value")
    tested = stage(battery(runs), "battery")
    # how often text changes its class, from all runs that are no candidates or fail the battery
    c, m = F.col("changes"), F.col("pairs")
    text = scanned.select("changes", "pairs").unionByName(tested.filter(F.col("p_random") < alpha).select(
        _changes(F.col("value")).alias("changes"), (F.length("value") - 1).cast("bigint").alias("pairs")))
    base = text.agg(((F.coalesce(F.sum(c), F.lit(0)) + 1) / (F.coalesce(F.sum(m), F.lit(0)) + 50)).alias("raw")).select(
        F.least(F.lit(0.3), F.greatest(F.lit(0.02), F.col("raw"))).alias("eps"))
    joined = tested.filter(F.col("p_random") >= alpha).crossJoin(F.broadcast(base))  # one row
    length = F.length("value").cast("double")
    share = _changes(F.col("value")) / (length - 1)
    gain = share * F.log(share / F.col("eps")) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - F.col("eps")))).otherwise(0.0)
    log_p = F.when(share > F.col("eps"), (length - 1) * gain / F.log(F.lit(10.0))).otherwise(0.0)
    scored = stage(joined.withColumn("band", _band(length)).withColumn("bin", F.least(F.floor(log_p / BIN), F.lit(TOP)).cast("int")).withColumn(
        "p_text", F.pow(F.lit(10.0), -log_p)), "scored")
    # step-up over the bins: at most a few thousand rows for each band
    bins = stage(scored.groupBy("band", "bin").agg(F.count("*").alias("n")), "bins")
    whole = Window.partitionBy("band")
    ranked = bins.withColumn("rank", F.sum("n").over(whole.orderBy(F.desc("bin")))).withColumn("m", F.sum("n").over(whole))
    good = ranked.filter(F.pow(F.lit(10.0), -F.col("bin") * BIN) * F.col("m") <= rate * F.col("rank"))
    least = stage(good.groupBy("band").agg(F.min("bin").alias("least")), "least")
    return scored.join(small_side(least), "band").filter(F.col("bin") >= F.col("least")).select(
        "doc_id", "version", "start", "end", "value", "encoding", "p_random", "p_text")


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, version, base, spans) for each row: arrays of (start, kind number, end) in order."""
    scanned = _scanned(docs)
    extra = random_runs(scanned).groupBy("doc_id", "version").agg(
        F.collect_set(F.struct("start", F.lit(3).alias("kind"), "end")).alias("extra")).withColumnsRenamed(
        {"doc_id": "d", "version": "v"})
    both = scanned.join(extra, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left")
    apart = F.filter(F.coalesce("extra", F.array().cast("array<struct<start:int,kind:int,end:int>>")), lambda r: ~F.exists(
        "base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return both.select("doc_id", "version", "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row."""
    found = secret_spans(docs)
    count = lambda n: F.size(F.filter("base", lambda s: s["kind"] == n)).cast("bigint")
    return found.select("doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS[:3])],
                        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents, all their columns, with ``mark`` in the place of each span; n_chars follows the text."""
    found = stage(secret_spans(docs).filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("_d"), F.col("version").alias("_v"), F.col("spans").alias("_s")).dropDuplicates(["_d", "_v"]), "found")
    both = docs.join(small_side(found), F.col("doc_id").cast("bigint").eqNullSafe(F.col("_d")) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_v")), "left")
    return cut_out(both, "_s", mark).select(*docs.columns)
