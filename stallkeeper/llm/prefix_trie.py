"""Prefix trie of conversations by truncation peeling.

A node of depth d is a distinct sequence of d first turns (role and text); it is named by a chain of SHA-256 digests, so texts are read
once.  Peeling starts at the greatest depth: conversations that end there are merged with the nodes that survive from below, each
group is a node whose figures are then complete, its last turn is stripped, and the rest is grouped again one level higher.  So nodes are
discovered and aggregated in the same pass, and every level costs one grouped aggregate over nodes, not over conversations: the
conversations with equal turns are merged before the first round.

Ancestors travel with a node for ``BAND`` levels at a time; the next band is fetched by one join on a member's conv_id.  Ended
conversations lie in one folder for each depth, so a round reads its own only, and writes its nodes to the shared folder, where the next
round finds them.  Where one conversation, or one group of equal ones, is alone, its last turns are stripped together (``strip_tails``), so
there are about as many rounds as the greatest depth at which different conversations still agree.

The digest over the ended members must see their ids in order.  Ids are dealt by ranges of (node, id), joined to texts of ``IDS`` ids in their
tasks, and the texts of a node are hashed one after the other, so no task holds the ids of a node.

A conversation is one row of digests (44 bytes a turn) while its turns are put in order.  Turns with null turn number come first; turns that share a
number follow each other by digest; repeated rows are turns of their own; null role or text is empty.  Rows without conv_id belong to no conversation
and are left out.  Remainders of negative ids follow SQL.  Without conversations there are no nodes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage, staging_path

BAND = 8
IDS = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()
_PATHS = "keys array<binary>, sizes array<bigint>"
_LEVEL = ("key binary, parent_key binary, depth int, conv_id bigint, n bigint, kids bigint, leaves bigint, saved bigint, "
          f"ends_sha256 string, {_PATHS}")


def conversations_in_order(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the digest and UTF-8 length of each turn, in order."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    slim = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("bigint").alias("size")).alias("t"))
    return slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def rebuilt(ordered: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation with the first h turns of the first one of its ``group`` ids in place of its own first h; h from its id's crc32."""
    base = ordered.select(F.col("conv_id").alias("base_id"), F.col("turns").alias("base"))
    own = ordered.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % group).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int"))
    none = F.array().cast(ordered.schema["turns"].dataType)
    return own.join(base, "base_id", "left").select("conv_id", F.concat(
        F.coalesce(F.slice("base", 1, F.col("h")), none), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def paths(convs: DataFrame) -> DataFrame:
    """(conv_id, depth, keys, sizes): the node of each depth, the root first, and the length of its last text."""
    def longer(keys: Column, turn: Column) -> Column:
        return F.array_append(keys, F.unhex(F.sha2(F.concat(F.element_at(keys, -1), turn["digest"]), 256)))

    keys = F.aggregate("turns", F.array(F.lit(b"")), longer)
    sizes = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("turns", lambda t: t["size"]))
    return convs.select("conv_id", F.size("turns").alias("depth"), keys.alias("keys"), sizes.alias("sizes"))


def ended(convs: DataFrame) -> DataFrame:
    """(conv_id, n, ends_sha256) for each node in which conversations end: the smallest, their number, the digest of all ids in order."""

    def join_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        full = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1][0] for r in rows], pa.int64()), pa.array([len(r[1]) for r in rows], pa.int64()),
             pa.array([",".join(map(str, r[1])) for r in rows])], ["key", "conv_id", "n", "ids"])
        for batch in batches:
            out = []
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key or len(ids) >= IDS:
                    if ids:
                        out.append((key, ids))
                    key, ids = k, []
                ids.append(i)
            if out:
                yield full(out)
        if ids:
            yield full([(key, ids)])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = sha = None
        n = 0
        for batch in batches:
            out = []
            for k, i, m, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key or sha is None:
                    if sha:
                        out.append((first, n, sha.hexdigest()))
                    key, first, n, sha = k, i, 0, hashlib.sha256()
                sha.update((("," if n else "") + ids).encode())
                n += m
            if out:
                yield _batch(out)
        if sha:
            yield _batch([(first, n, sha.hexdigest())])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string()])], ["conv_id", "n", "ends_sha256"])

    ids = convs.select(F.element_at("keys", -1).alias("key"), "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = ids.mapInArrow(join_ids, "key binary, conv_id long, n long, ids string")
    return texts.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(digest, "conv_id long, n long, ends_sha256 string")


def prefix_trie(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    return peel(stage(paths(rebuilt(stage(conversations_in_order(turns), "turns"), group, most)), "paths"))


def _band(c: str, band: Column) -> Column:
    """Entries of depths band*BAND to (band+1)*BAND."""
    return F.slice(c, band * BAND + 1, BAND + 1).alias(c)


def strip_tails(ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to peel, nodes of the tails): levels that hold one row of ``ends`` only are stripped from it at once.

    Asked for every BAND levels, so a row gives one key for each band it passes through, and rows of up to BAND turns none.  What is stripped
    is one chain of nodes; the row goes on from its foot, with the figures of the chain.
    """
    none = F.lit(0).cast("bigint")
    feet = F.sequence(F.lit(1), F.floor((F.col("depth") - 1) / BAND).cast("int"))
    deep = ends.filter(F.col("depth") > BAND)
    alone = deep.select("conv_id", "keys", F.explode(feet).alias("foot")).select(
        "conv_id", "foot", F.element_at("keys", F.col("foot") * BAND + 1).alias("key")).groupBy("key").agg(
        F.count("*").alias("rows"), F.min("conv_id").alias("conv_id"), F.min("foot").alias("foot")).filter("rows = 1")
    cut = deep.join(alone.groupBy("conv_id").agg((F.min("foot") * BAND).cast("int").alias("foot")), "conv_id", "left")
    cut = stage(cut, "tails")
    tailed = cut.filter(F.col("foot").isNotNull())
    chain = F.aggregate(F.slice("sizes", F.col("foot") + 2, F.size("sizes")), none, lambda a, x: a + x)
    heads = tailed.select("conv_id", "n", F.lit(None).cast("string").alias("ends_sha256"), F.slice("keys", 1, F.col("foot") + 1).alias("keys"),
                          F.slice("sizes", 1, F.col("foot") + 1).alias("sizes"), F.col("foot").alias("depth"), none + 1, none + 1, (F.col("n") - 1) * chain)
    plain = ["conv_id", "n", "ends_sha256", "keys", "sizes", "depth", none.alias("kids"), none.alias("leaves"), none.alias("saved")]
    heads = ends.filter(F.col("depth") <= BAND).select(*plain).union(cut.filter(F.col("foot").isNull()).select(*plain)).union(heads)
    each = tailed.select("*", F.explode(F.sequence(F.col("foot") + 1, F.col("depth"))).alias("at"))
    last = F.col("at") == F.col("depth")
    rest = F.aggregate(F.slice("sizes", F.col("at") + 1, F.size("sizes")), none, lambda a, x: a + x)
    nodes = each.select(
        F.element_at("keys", F.col("at") + 1).alias("key"), F.element_at("keys", F.col("at")).alias("parent_key"), F.col("at").alias("depth"), "conv_id", "n",
        F.when(last, 0).otherwise(1).cast("bigint").alias("kids"), F.lit(1).cast("bigint").alias("leaves"), ((F.col("n") - 1) * rest).alias("saved"),
        F.when(last, F.col("ends_sha256")).alias("ends_sha256"))
    return heads, nodes


def peel(convs: DataFrame) -> DataFrame:
    """The trie of ``convs``, staged rows of ``paths``."""
    spark = convs.sparkSession
    heads, tails = strip_tails(stage(ended(convs).join(convs, "conv_id"), "ends"))
    heads = stage(heads, "heads")
    deepest = heads.agg(F.max("depth")).first()[0]
    if deepest is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    top = F.greatest(F.floor((F.col("depth") - 1) / BAND), F.lit(0)).cast("int")
    lower = staging_path(spark, "bands")
    if deepest > BAND:
        heads.filter(F.col("depth") > BAND).select("conv_id", "keys", "sizes", F.explode(F.sequence(F.lit(0), top - 1)).alias("band")).select(
            "conv_id", _band("keys", F.col("band")), _band("sizes", F.col("band")), "band").write.partitionBy("band").parquet(lower)
        lower = spark.read.schema(f"conv_id bigint, {_PATHS}, band int").parquet(lower)
    path = staging_path(spark, "by_depth")
    heads.withColumns({"keys": _band("keys", top), "sizes": _band("sizes", top)}).hint("rebalance", "depth").write.partitionBy("depth").parquet(path)
    heads = spark.read.schema(heads.schema).parquet(path)

    levels = staging_path(spark, "levels")
    alive = None  # nodes of the level below, without their last turn
    for depth in range(deepest, -1, -1):
        band = max(depth - 1, 0) // BAND
        at = depth - band * BAND + 1
        if alive is not None and at > BAND:
            alive = alive.drop("keys", "sizes").join(lower.filter(F.col("band") == band).drop("band"), "conv_id")
        new = heads.filter(F.col("depth") == depth).select(
            "conv_id", "n", "ends_sha256", "keys", "sizes", "kids", "leaves", "saved")
        path = f"{levels}/level={depth}"
        _merged(new if alive is None else new.unionByName(alive), at, depth).write.parquet(path)
        level = spark.read.schema(_LEVEL).parquet(path)
        alive = level.select("conv_id", "n", F.lit(None).cast("string").alias("ends_sha256"), F.slice("keys", 1, max(at - 1, 0)).alias("keys"),
                             F.slice("sizes", 1, max(at - 1, 0)).alias("sizes"), F.lit(1).cast("bigint").alias("kids"), "leaves", "saved")
    nodes = spark.read.schema(_LEVEL).parquet(levels).drop("keys", "sizes", "level").unionByName(tails)
    top_id = level.first()["conv_id"]  # the root
    parents = nodes.filter((F.col("depth") > 0) & (F.col("kids") > 0)).select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.filter(F.col("depth") > 1).join(parents, "parent_key", "left")
    high = nodes.filter(F.col("depth") <= 1).withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(top_id)).cast("bigint"))
    return deep.unionByName(high).select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def _merged(rows: DataFrame, at: int, depth: int) -> DataFrame:
    """One row for each node of a level, from what ends there and what was stripped to it; ``at`` is its place in keys."""
    grouped = rows.groupBy(F.element_at("keys", at).alias("key")).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.max("ends_sha256").alias("ends_sha256"), F.first("keys").alias("keys"), F.first("sizes").alias("sizes"))
    parent = F.element_at("keys", at - 1) if at > 1 else F.lit(None).cast("binary")
    return grouped.select(
        "key", parent.alias("parent_key"), F.lit(depth).alias("depth"), "conv_id", "n", "kids",
        F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("bigint").alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.element_at("sizes", at)).alias("saved"), "ends_sha256", "keys", "sizes")
