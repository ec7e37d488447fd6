"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation is learned (at most ``fit_rows`` vectors) so that the signs of the rotated principal components are balanced
bits.  The code is cut into parts; one table per part holds every vector under its part.  A vector looks itself up
under its own part and all parts that differ in one bit, so a pair is found if the codes differ by at most one bit in any
part.  Pairs are kept in the first table that finds them, so none is counted twice, and verified on the
original vectors in double precision.  Equal vectors are one before the search.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without label or vec_id, link with
nothing.  Vectors of another length than the fitted ones get a fixed random rotation; lengths are never mixed.
Rows repeating a vec_id with equal vectors are one; with different vectors each row is searched and counts as a vector.
Equal similarities need no rule; the smallest vec_id names a class.  Columns other than vec_id, embedding and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import components

BITS = 64


def learn_rotation(x: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(centre, projection with ``bits`` columns): principal axes turned so that rounding to signs loses least.

    More bits than dimensions come from further turns of the axes, each learned from another start.
    """
    centre = x.mean(0)
    z = x - centre
    dim = x.shape[1]
    _, axes = np.linalg.eigh(z.T @ z)
    axes = axes[:, ::-1][:, :min(bits, dim)]
    v = z @ axes
    out, rng = [], np.random.default_rng(seed)
    while sum(o.shape[1] for o in out) < bits:
        r = np.linalg.qr(rng.normal(size=(v.shape[1],) * 2))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (left @ right).T
        out.append(axes @ r)
    return centre, np.column_stack(out)[:, :bits]


def fixed_rotation(dim: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(dim), np.random.default_rng(dim).normal(size=(dim, bits))


def usable(values: list | None) -> np.ndarray | None:
    if not values or any(v is None for v in values):
        return None
    x = np.asarray(values, np.float64)
    norm = np.sqrt(x @ x) if np.isfinite(x).all() else 0.0
    return x / norm if norm > 0 and np.isfinite(norm) else None


def _coded(rows: DataFrame, rotation: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """(vec_id, label, key, dim, code, unit): usable vectors with a digest, their sign code and unit form."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = {} if rotation is None else {len(rotation[0]): rotation}
        weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for batch in batches:
            out = []
            for vec_id, label, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                u = usable(values)
                if u is not None:
                    if len(u) not in turns:
                        turns[len(u)] = fixed_rotation(len(u))
                    centre, axes = turns[len(u)]
                    code = int(weights[(u - centre) @ axes >= 0].sum())
                    digest = hashlib.blake2b(f"{label}:".encode() + np.asarray(values, np.float64).tobytes(), digest_size=8).digest()
                    out.append((vec_id, label, int.from_bytes(digest, "little", signed=True), len(u),
                                code - (1 << 64) if code >> 63 else code, u.tolist()))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["vec_id", "label", "key", "dim", "code", "unit"])

    return rows.mapInArrow(run, "vec_id long, label long, key long, dim int, code long, unit array<double>")


def fit(rows: DataFrame, fit_rows: int = 10_000) -> tuple[np.ndarray, np.ndarray] | None:
    got = [usable(r.embedding) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).collect()]
    got = [u for u in got if u is not None]
    sizes = np.array([len(u) for u in got], int)
    if not len(sizes):
        return None
    dim = np.bincount(sizes).argmax()
    return learn_rotation(np.array([u for u in got if len(u) == dim]))


def _part(code, table: int, width: int):
    return F.shiftrightunsigned(code, table * width).bitwiseAND(F.lit((1 << width) - 1))


def found_pairs(vectors: DataFrame, tables: int = 4) -> DataFrame:
    """Staged pairs (a, b) of keys, a < b, whose codes differ by at most one bit in a part; each pair once."""
    width = BITS // tables
    home = vectors.select("label", "dim", "key", "code", F.posexplode(F.array(*[_part(F.col("code"), t, width) for t in range(tables)])).alias(
        "table", "part"))
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << k).cast("bigint") for k in range(width)])
    probe = home.select("label", "dim", F.col("key").alias("a"), F.col("code").alias("code_a"), "table", "part",
                        F.explode(flips).alias("flip")).withColumn("part", F.col("part").bitwiseXOR(F.col("flip"))).drop("flip")
    index = home.select("label", "dim", F.col("key").alias("b"), F.col("code").alias("code_b"), "table", "part")
    differ = F.col("code_a").bitwiseXOR(F.col("code_b"))
    earlier = F.lit(False)
    for t in range(tables):
        earlier = earlier | ((F.col("table") > t) & (F.bit_count(_part(differ, t, width)) <= 1))
    pairs = probe.join(index, ["label", "dim", "table", "part"]).filter((F.col("a") < F.col("b")) & ~earlier)
    return stage(pairs.select("a", "b"), "pairs")


def embedding_classes(rows: DataFrame, cosine: float = 0.98, fit_rows: int = 10_000, tables: int = 4) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row."""
    slim = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    live = slim.filter("vec_id is not null and label is not null and embedding is not null")
    rotation = fit(live, fit_rows)
    coded = stage(_coded(live, rotation), "coded")
    members = coded.select("vec_id", "key").distinct()
    sizes = members.groupBy("key").agg(F.count("*").alias("copies"), F.min("vec_id").alias("lowest"))
    vectors = stage(coded.groupBy("key").agg(*[F.first(c).alias(c) for c in ("label", "dim", "code", "unit")]), "vectors")

    unit = lambda s: vectors.select(F.col("key").alias(s), F.col("unit").alias(f"unit_{s}"))
    dot = F.aggregate(F.zip_with("unit_a", "unit_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    links = stage(found_pairs(vectors, tables).join(unit("a"), "a").join(unit("b"), "b").filter(dot >= cosine).select("a", "b"), "links")

    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(sizes.select(F.col("key").alias("b"), "copies"), "b").groupBy(F.col("a").alias("key")).agg(
        F.sum("copies").alias("others"))
    named = sizes.join(components(links).withColumnRenamed("id", "key"), "key", "left").withColumn("class", F.coalesce("component", "key"))
    lowest = named.groupBy("class").agg(F.min("lowest").alias("component_id"))
    facts = named.join(lowest, "class").join(linked, "key", "left").select(
        "key", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    mine = members.join(facts, "key").groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    result = slim.select("vec_id").join(mine, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
