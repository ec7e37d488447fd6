"""Pivot clusters, prefix trie and packing against plain Python on small tables."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from stallkeeper.llm import packing, pivot_clusters, prefix_trie
from stallkeeper.llm.byte_bpe import ByteBPE

BPE = public_tokenizers.path("byte_bpe_50k.json")


# ---- ids ------------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    return ByteBPE(BPE)


def test_ids_are_the_librarys_on_all_kinds_of_characters(bpe):
    assert bpe.fast is not None
    rng = random.Random(3)
    blocks = [(0, 0x250), (0x370, 0x600), (0x900, 0xE80), (0x2000, 0x2100), (0x3040, 0x3100), (0x4E00, 0x4F00), (0xAC00, 0xAC80), (0x1F600, 0x1F650)]
    texts = ["", " ", "\n\n", " a", "it's  we'LL x'", "a" * 5000, "=-" * 3000, "<|endoftext|> in a text <|endoftext|>", "1234567890" * 50]
    for low, high in blocks:
        for _ in range(40):
            texts.append("".join(chr(rng.randrange(low, high)) if rng.random() < 0.7 else rng.choice(" \t\n.,'a1") for _ in range(60)))
    for text in texts:
        assert bpe.ids(text).tolist() == bpe.library.encode(text, add_special_tokens=False).ids, text[:40]


def test_files_of_another_make_go_through_the_library():
    other = ByteBPE(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None
    assert other.ids("Two words").tolist() == other.library.encode("Two words", add_special_tokens=False).ids


# ---- packing ----------------------------------------------------------------

def test_cuts_leave_the_short_piece_in_front():
    assert packing.cuts(5, 10) == [0, 5] and packing.cuts(10, 10) == [0, 10]
    assert packing.cuts(11, 10) == [0, 1, 11] and packing.cuts(30, 10) == [0, 10, 20, 30]


def plain_sum_of_squares(lengths, capacity):
    """Every possible place is tried and the sum of squares counted anew."""
    free = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        total = lambda gaps: sum(v * v for v in map(gaps.count, {g for g in gaps if 0 < g < capacity}))
        options = {g: total([x for k, x in enumerate(free) if k != free.index(g)] + [g - n]) for g in set(free) if g >= n}
        if options:
            g = min(options, key=lambda g: (options[g], g))
            free[free.index(g)] -= n
        else:
            free.append(capacity - n)
    return sorted(free)


def test_each_piece_goes_where_the_sum_of_squares_is_smallest():
    rng = random.Random(1)
    for _ in range(30):
        capacity = rng.choice([7, 20, 64])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 40))]
        sequence, offset, free = packing.sum_of_squares(np.array(lengths, np.int64), capacity)
        left = {int(s): int(f) for s, f in zip(sequence, free)}
        assert sorted(left.values()) == plain_sum_of_squares(lengths, capacity)
        for s in left:
            own = sorted((int(o), n) for o, n, q in zip(offset, lengths, sequence) if q == s)
            assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
            assert sum(n for _, n in own) + left[s] == capacity


def check_packed(rows, texts, capacity, end_id, bpe):
    got = defaultdict(list)
    for r in rows:
        got[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in got.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    pieces = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows))
    expected = []
    for doc_id, text in texts:
        ids = np.array(bpe.library.encode(text or "", add_special_tokens=False).ids + [end_id], "<u4")
        bounds = packing.cuts(len(ids), capacity)
        expected += [(doc_id is not None, doc_id or 0, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    assert pieces == sorted(expected)
    return len(got)


def test_packing_of_odd_rows_and_long_texts(documents, odd, bpe):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma delta", "x"]
    texts = odd + [(100 + i, " ".join(rng.choices(words, k=rng.randint(0, 90)))) for i in range(300)] + [(900, "long text " * 20_000), (901, "z" * 300_000)]
    rows = packing.pack_documents(documents(texts), BPE, capacity=64, group_rows=50).collect()
    used = check_packed(rows, texts, 64, 2, bpe)
    whole = sum(r["length"] for r in rows)
    assert used <= math.ceil(whole / 64) * 1.02 + 2


def test_sequences_hold_the_tokens_of_their_documents(documents, bpe):
    texts = [(i, f"document number {i} " * (i % 7)) for i in range(60)]
    rows = packing.packed_sequences(documents(texts), BPE, capacity=32).collect()
    seen = defaultdict(int)
    for r in rows:
        assert len(r["ids"]) <= 32 and r["offsets"][0] == 0
        for i, (doc_id, a) in enumerate(zip(r["doc_ids"], r["offsets"])):
            b = r["offsets"][i + 1] if i + 1 < len(r["offsets"]) else len(r["ids"])
            seen[doc_id] += b - a
            if len(r["ids"]) < 32 and b == len(r["ids"]):
                assert r["ids"][-1] == 2
    assert seen == {i: len(bpe.ids(t)) + 1 for i, t in texts}


def test_packing_of_an_empty_table(documents):
    out = packing.pack_documents(documents([]), BPE)
    assert out.count() == 0
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


# ---- clusters -----------------------------------------------------------------

def plain_clusters(rows, k, rounds, size, scale=64):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j])] if own[j] else c for j, c in enumerate(centroids)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    inertia = defaultdict(int)
    for _, j, d in out:
        inertia[j] += d
    mark = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is not None, i or 0, j, d, inertia[j], sum(inertia.values()), mark[j]) for i, j, d in out))


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", [1.0]) for i, v in rows],
                                 "vec_id long, embedding array<float>, cluster int, distance string, x array<double>")


def found(df):
    return sorted(((r[0] is not None, r[0] or 0, *r[1:]) for r in df.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_plain_k_means(spark, documents, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a hot group of equal vectors
    rows += [(i, [0.5] * 6) for i in (7, 7, 8)] + [(None, [0.25] * 6)]  # repeated ids, ties, no id
    rows += [(2000, None), (2001, [1.0] * 5), (2002, [1.0] * 5 + [None]), (2003, [float("nan")] + [0.0] * 5), (2004, [float("inf")] * 6), (2005, [])]
    got = found(pivot_clusters.cluster(vectors(spark, rows), k=8, rounds=3, size=6))
    assert got == plain_clusters(rows, 8, 3, 6)


def test_large_components_keep_exact_distances(spark, documents):
    rows = [(i, [float(2 ** (14 + i % 9)), float(i), -float(2 ** (i % 22))]) for i in range(80)]
    assert found(pivot_clusters.cluster(vectors(spark, rows), k=5, rounds=2, size=3)) == plain_clusters(rows, 5, 2, 3)
    huge = rows + [(500, [3.0e38, 0.0, 0.0]), (501, [-3.0e38, 1.0, 0.0])]
    out = pivot_clusters.cluster(vectors(spark, huge), k=5, rounds=2, size=3).collect()
    assert len(out) == 82 and max(r["distance"] for r in out) <= pivot_clusters.TOP


def test_fewer_vectors_than_clusters_and_none(spark, documents):
    rows = [(1, [0.0, 1.0]), (2, [5.0, 1.0])]
    assert found(pivot_clusters.cluster(vectors(spark, rows), k=16, size=2)) == plain_clusters(rows, 16, 3, 2)
    assert pivot_clusters.cluster(vectors(spark, []), size=2).count() == 0
    assert pivot_clusters.cluster(vectors(spark, [(None, [0.0, 1.0])]), size=2).count() == 0


def test_bounds_leave_out_centroids_and_never_the_nearest():
    rng = np.random.default_rng(4)
    middle = rng.integers(-500, 500, (16, 8))
    x = middle[rng.integers(0, 16, 2000)] + rng.integers(-20, 20, (2000, 8))
    to_pivots = np.stack([pivot_clusters.roots(pivot_clusters.distances(x, p)) for p in middle], 1)
    near, best, taken = pivot_clusters.nearest(x, to_pivots, middle, middle)
    plain = ((x[:, None, :] - middle[None]) ** 2).sum(2)
    assert (near == plain.argmin(1)).all() and (best == plain.min(1)).all()
    assert taken < 2 * len(x)  # of 16 for each vector


# ---- trie ---------------------------------------------------------------------

def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), r or "", x or ""))
    turns = {c: [(r, x) for _, r, x in sorted(v, key=lambda v: v[0])] for c, v in turns.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                kids[path[:d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        text = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * text + sum(saved[k] for k in kids[node])
    ids = lambda node: ",".join(map(str, sorted(ends[node])))
    return sorted((len(n), min(m), min(members[n[:-1]]) if n else -1, len(m), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(ids(n).encode()).hexdigest()) for n, m in members.items())


def trie_rows(df):
    return sorted((r["depth"], r["conv_id"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, depth int")


def test_trie_equals_plain_prefixes(spark, documents, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 3)  # ids of one node in many texts
    rng = random.Random(7)
    rows = []
    for c in range(160):
        shape = c % 4
        n = rng.randint(1, 6) if shape else 3
        for t in range(n):
            text = "same" if shape == 0 else rng.choice(["a", "b", "é", None])
            rows.append((c, t if rng.random() < 0.97 or t else None, rng.choice(["user", None]) if shape == 3 else "user", text))
    rows += [(300, t, "user", f"tail {t}") for t in range(40)] + [(301, t, "user", f"tail {t}") for t in range(40)]  # long, alone or together
    rows += [(302, t, "user", f"tail {t}" if t < 21 else f"other {t}") for t in range(33)]
    rows += [(403, t, "user", "x" * 50_000) for t in range(12)]  # its base is absent
    rows += [(None, 0, "user", "nobody's turn"), (411, 0, None, None), (412, None, "", "")]
    assert trie_rows(prefix_trie.prefix_trie(conversations(spark, rows))) == plain_trie(rows)


def test_trie_of_repeated_rows_and_of_nothing(spark, documents):
    rows = [(5, 0, "user", "hi"), (5, 0, "user", "hi"), (6, 0, "user", "hi")]
    assert trie_rows(prefix_trie.prefix_trie(conversations(spark, rows))) == plain_trie(rows)
    empty = prefix_trie.prefix_trie(conversations(spark, []))
    assert empty.count() == 0 and len(empty.columns) == 8


def test_conversations_without_turns_are_members_of_the_root(spark, documents):
    rows = [(c, 0, "user", f"only {c}") for c in range(1, 5)]  # the base, 0, is absent, so most lose their only turn
    got = trie_rows(prefix_trie.prefix_trie(conversations(spark, rows)))
    assert got == plain_trie(rows)
    assert got[0][:5] == (0, 1, -1, 4, sum(1 for r in got if r[0] == 1))
