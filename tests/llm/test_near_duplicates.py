"""N-gram Jaccard classes and embedding classes against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallkeeper.llm import embedding_dedup, jaccard_join
from stallkeeper.llm.common import components


def smallest(pairs, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def linked(sets):
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                yield a, b


def corpus(seed):
    """Groups of copies edited a little or much, common lines, tiny texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(300)]
    line = " ".join(rng.choices(vocabulary, k=15))
    docs = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([8, 40, 120]))
        for _ in range(rng.randint(1, 14)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            docs.append(" ".join(w) + (f"\n{line}" if rng.random() < 0.4 else ""))
    docs += ["a b", "A  B", "a b c d e", "a b c d e f", "x", "x y z", ""]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_brute_force(documents, seed):
    docs = corpus(seed)
    sets = {i: shingles(t) for i, t in docs}
    want = smallest(linked(sets), sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(documents(docs)).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_many_edited_copies_make_no_quadratic_rows(documents, monkeypatch):
    rng = random.Random(3)
    base = rng.choices([f"v{k}" for k in range(900)], k=150)
    docs = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 3, 8, 25])):
            w[rng.randrange(len(w))] = f"e{rng.random()}"
        docs.append((i, " ".join(w)))
    sets = {i: shingles(t) for i, t in docs}
    seen = []
    plain = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *a: (seen.append(pairs.count()), plain(pairs, *a))[1])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(documents(docs)).collect()}
    assert got == smallest(linked(sets), sets) and max(seen) < 150 * 149 / 8


def test_texts_with_many_own_shingles_meet_no_one(documents, monkeypatch):
    """One text of the family in each partition: only counts over all of them tell common shingles from own ones."""
    rng = random.Random(8)
    base = [f"v{k}" for k in range(200)]
    docs = []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(0, 200, 6), 14):
            w[at] = f"own{rng.random()}"
        docs.append((i, " ".join(w)))
    docs += [(100, docs[0][1] + " tail"), (101, docs[1][1])]
    sets = {i: shingles(t) for i, t in docs}
    seen = []
    plain = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *a: (seen.append(pairs.count()), plain(pairs, *a))[1])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(documents(docs).repartition(30)).collect()}
    assert got == smallest(linked(sets), sets) and got[100] == 0 and got[101] == 1
    assert max(seen) <= 2


def test_word_hashes_do_not_depend_on_place_or_case():
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abc\u00e9\u4e2d", k=rng.randint(1, 9))).encode() for _ in range(3000)} | {b"x" * (jaccard_join.PLACES + 3)})
    starts, codes = jaccard_join.word_codes(np.frombuffer(b" \t".join(words), np.uint8))
    assert len(starts) == len(words) == len(set(codes.tolist()))
    for w, code in zip(words[::100] + words[-1:], codes[::100].tolist() + codes[-1:].tolist(), strict=True):
        for before in (1, jaccard_join.PLACES - 2):
            assert jaccard_join.word_codes(np.frombuffer(b" " * before + w.upper() + b"\n", np.uint8))[1].tolist() == [code]
    assert [len(s) for s in jaccard_join.shingle_sets(["", " \n", "a B", "a b c d e", "A b c d e a b c d e", "a"], 5)] == [0, 0, 1, 1, 5, 1]


def test_common_tokens_are_counted_over_all_ranges(documents):
    docs = documents([(i, "one two three four five six" if i < 20 else f"w{i} b{i} c d e f{i}") for i in range(40)]).repartition(5)
    both = next(jaccard_join.shingle_sets(["one two three four five six"], 5))
    for bits in (1, 10):
        got = {r["token"]: r["n"] for r in jaccard_join._counts(docs, 5, bits).collect()}
        assert got == {int(t) >> (32 - bits): 20 for t in both}


def test_large_classes_of_near_copies_become_one_before_pairs_are_made(documents, monkeypatch):
    """Two crowds of near copies that only a chain of members links leave no pairs of their members."""
    rng = random.Random(4)
    base = [f"v{k}" for k in range(160)]
    docs = []
    for i in range(240):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            w[rng.randrange(len(w))] = f"e{rng.random()}"
        docs.append((i, " ".join(w)))
    sets = {i: shingles(t) for i, t in docs}
    seen = []
    plain = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *a: (seen.append(pairs.count()), plain(pairs, *a))[1])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_classes(documents(docs)).collect()}
    assert got == smallest(linked(sets), sets) and max(seen) <= 20 * len(docs)


def test_odd_rows_and_empty_table(documents, odd):
    got = jaccard_join.jaccard_classes(documents(odd)).collect()
    assert len(got) == len(odd)
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert all(r["component_id"] == r["doc_id"] for r in got if r["doc_id"] is not None)
    assert sorted(r["n_shingles"] for r in got if r["doc_id"] in (1, 2, 3)) == [0, 0, 0]
    assert jaccard_join.jaccard_classes(documents([])).count() == 0


def test_one_of_each_keeps_the_smallest(documents):
    docs = documents([(3, "a b c d e f g"), (1, "A b c d e f g"), (2, "other words in a line here"), (None, "a b c d e f g"), (9, None)])
    out = jaccard_join.one_of_each(docs)
    assert out.columns == docs.columns and sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "9", "None"]


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 120)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in smallest(edges, {x for e in edges for x in e}).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for label in (1, 2, 3):
        for _ in range(60):
            centre = rng.normal(size=32)
            for _ in range(rng.integers(1, 6)):
                rows.append(((centre + rng.normal(size=32) * rng.choice([0.0, 0.05, 0.12])).astype("float32").tolist(), label))
    rng.shuffle(order := np.arange(len(rows)))
    return [(int(k), *rows[i]) for k, i in enumerate(order)]


def embedded(spark, rows):
    from stallkeeper.llm.common import ship

    ship(spark)
    return spark.createDataFrame([(i, v, y, "clash") for i, v, y in rows], "vec_id long, embedding array<float>, label int, component_id string")


def test_embedding_links_and_recall(spark, vectors):
    x = np.array([v for _, v, _ in vectors], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([label for *_, label in vectors])
    true = [(a, b) for a in range(len(y)) for b in range(a) if y[a] == y[b] and x[a] @ x[b] >= 0.98]
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_classes(embedded(spark, vectors)).collect()}
    found = sum(r["n_links"] for r in got.values()) / 2
    assert 0.9 * len(true) <= found <= len(true)
    want = smallest(true, range(len(y)))
    assert sum(got[i]["component_id"] == want[i] for i in want) >= 0.95 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_pairs_come_once_and_within_a_bit(spark, vectors):
    coded = embedding_dedup._coded(embedded(spark, vectors).selectExpr("vec_id", "cast(label as long) label", "embedding"), None)
    one = coded.groupBy("key").agg(*[F.first(c).alias(c) for c in ("label", "dim", "code", "unit")])
    pairs = embedding_dedup.found_pairs(one).collect()
    assert len(pairs) == len(set(pairs))
    codes = {r["key"]: (r["label"], r["code"] & (1 << 64) - 1) for r in one.collect()}
    near = lambda a, b: any(bin((a >> s ^ b >> s) & 0xFFFF).count("1") <= 1 for s in (0, 16, 32, 48))
    keys = sorted(codes)
    want = {(a, b) for n, b in enumerate(keys) for a in keys[:n] if codes[a][0] == codes[b][0] and near(codes[a][1], codes[b][1])}
    assert {tuple(p) for p in pairs} == want


def test_odd_vectors(spark):
    nan, one = float("nan"), [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, nan, 2.0], 1), (5, [1.0, None, 2.0], 1), (6, one, None), (None, one, 1),
            (7, one, 1), (8, one, 1), (8, one, 1), (9, one, 2), (10, [2.0, 4.0, 6.0], 1), (11, [1.0, 2.0], 1)]
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.embedding_classes(embedded(spark, rows)).collect()}
    assert got == {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 11, None)} | {(7, 2, 7, True), (8, 2, 7, False), (10, 2, 7, False)}
    assert embedding_dedup.embedding_classes(embedded(spark, [])).count() == 0
