"""Pair jobs against brute force on small tables with heavy groups."""

import itertools
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from stallkeeper.functions import text
from stallkeeper.operators import simjoin
from stallkeeper.operators.simjoin import in_cells, jaccard_join
from stallkeeper.plans import analytics, features, text_jobs
from stallkeeper.session import parts_for, stage


def people(spark):
    rows = [(i, f"F{i}", f"L{i}", "Paris" if i % 3 == 0 or i > 20 else f"C{i % 4}", "FR" if i % 2 else "DE") for i in range(40)]
    return rows, spark.createDataFrame(rows, "customer_id long, first_name string, last_name string, city string, country string")


def brute_pairs(rows):
    return {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if a[3:] == b[3:]}


def test_city_links_expand_to_all_pairs(spark):
    rows, df = people(spark)
    links = analytics.same_city_pairs(df, block_rows=3).collect()
    follow = {r["customer1_id"]: r["customer2_id"] for r in links}
    pairs = set()
    for start in follow:
        at = start
        while at in follow:
            at = follow[at]
            pairs.add((start, at))
    assert pairs == brute_pairs(rows)
    assert sum(r["later_partners"] for r in links) == len(pairs)


def test_city_partners_of_chosen_and_of_all(spark):
    rows, df = people(spark)
    ids = lambda d: {(r["customer1_id"], r["customer2_id"]) for r in d.collect()}
    assert ids(analytics.same_city_partners(df, df)) == brute_pairs(rows)
    some = spark.createDataFrame([(3,), (24,)], "customer_id long")
    assert ids(analytics.same_city_partners(df, some)) == {p for p in brute_pairs(rows) if 3 in p or 24 in p}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def similar(spark, texts, hot_token):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard_join(docs, "doc_id", text.tokens("text"), 0.5, hot_token=hot_token).collect()
    rep = {i: i for i in range(len(texts))}
    score = {}
    for r in rows:
        if r["similarity"] == 1.0:
            rep[r["doc_b"]] = r["doc_a"]
        else:
            score[(r["doc_a"], r["doc_b"])] = r["similarity"]
    found = {}
    for a, b in itertools.combinations(range(len(texts)), 2):
        ra, rb = sorted((rep[a], rep[b]))
        if ra == rb:
            found[(a, b)] = 1.0
        elif (ra, rb) in score:
            found[(a, b)] = score[(ra, rb)]
    return rows, found


def test_similarity_join_matches_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{min(int(rng.expovariate(0.15)), 40)}" for _ in range(rng.randint(1, 14))) for _ in range(90)]
    texts += ["copy of one text"] * 12 + ["Copy of one TEXT!", "copy of one text again", "", "   ", "x", "x y", "y"]
    sets = [set(re.findall(r"\w+", t.lower())) for t in texts]
    want = {(a, b): jaccard(sets[a], sets[b]) for a, b in itertools.combinations(range(len(texts)), 2)
            if sets[a] and sets[b] and jaccard(sets[a], sets[b]) > 0.5}
    for hot in (20_000, 3):
        rows, found = similar(spark, texts, hot)
        assert {k: v for k, v in found.items() if sets[k[0]]} == want
        # linear in copies: 13 equal texts give 12 rows, not 78
        copies = [r for r in rows if r["similarity"] == 1.0 and r["doc_a"] == 90]
        assert len(copies) == 12 and copies[0]["copies_a"] == 13


def test_copurchase_matches_brute_force(spark):
    rng = random.Random(3)
    lines = [(o, rng.randint(0, 9)) for o in range(30) for _ in range(rng.randint(1, 5))] + [(99, p) for p in range(10)] * 3
    df = spark.createDataFrame(lines, "order_id long, product_id long")
    anchors = spark.createDataFrame([(1,), (4,)], "product_id long")
    baskets = {}
    for o, p in lines:
        baskets.setdefault(o, set()).add(p)
    n = lambda *ps: sum(all(p in b for p in ps) for b in baskets.values())
    got = {(r["anchor_id"], r["partner_id"]): (r["together"], round(r["support"], 9), round(r["lift"], 9))
           for r in features.copurchase_features(df, anchors).collect()}
    total = len(baskets)
    want = {(a, p): (n(a, p), round(n(a, p) / total, 9), round(n(a, p) * total / (n(a) * n(p)), 9))
            for a in (1, 4) for p in range(10) if p != a and n(a, p)}
    assert got == want


def test_top_products_ties(spark):
    products = spark.createDataFrame([(i, f"p{i}", "A" if i < 8 else "B") for i in range(10)], "product_id long, product_name string, category string")
    items = spark.createDataFrame([(i, 10.0) for i in range(10)], "product_id long, line_total double")
    got = features.top_products_per_category(products, items, 2).orderBy("category", "category_rank").collect()
    assert [(r["category"], r["product_id"]) for r in got] == [("A", 0), ("A", 1), ("B", 8), ("B", 9)]


def test_all_copurchase_pairs_match_brute_force(spark):
    from collections import Counter
    from itertools import permutations

    rng = random.Random(11)
    baskets = {o: {rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))} for o in range(60)}
    rows = [(o, p) for o, b in baskets.items() for p in b for _ in range(rng.randint(1, 2))] + [(900, "z"), (901, "y"), (901, "z")]
    baskets |= {900: {"z"}, 901: {"y", "z"}}
    sold, pairs = Counter(p for b in baskets.values() for p in b), Counter(x for b in baskets.values() for x in permutations(b, 2))
    got = {(r["anchor_id"], r["partner_id"]): (r["together"], r["confidence"], r["lift"]) for r in features.copurchase_pairs(
        spark.createDataFrame(rows, "order_id long, product_id string"), 3).collect()}
    assert got == {(a, b): (n, n / sold[a], n * len(baskets) / (sold[a] * sold[b])) for (a, b), n in pairs.items() if n >= 3}


def test_a_set_travels_once_to_each_cell_not_once_with_each_pair(spark):
    pairs = stage(spark.createDataFrame(list(itertools.combinations(range(60), 2)), "a long, b long"), "pairs")
    sets = spark.createDataFrame([(i, ["x" * 50, f"w{i}"]) for i in range(60)], "rep long, tokens array<string>")

    def sizes(p, s):
        return pa.table({"pairs": [p.num_rows], "sets": [s.num_rows], "different": [len(set(s["rep"].to_pylist()))]})

    rows = in_cells(pairs, sets, 20, sizes, "pairs long, sets long, different long").collect()
    assert len(rows) <= 9 and sum(r["pairs"] for r in rows) == 1770
    assert all(r["sets"] == r["different"] for r in rows) and sum(r["sets"] for r in rows) <= 2 * 3 * 60


def test_many_near_copies_in_small_cells_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simjoin, "BITMAP_BLOCK", 8)
    monkeypatch.setattr(simjoin, "TOKEN_BLOCK", 3)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(w for k, w in enumerate(words) if k % 11 != i % 11) + f" own{i}" for i in range(40)]
    sets = [set(t.split()) for t in texts]
    _, found = similar(spark, texts, 5)
    assert found == {(a, b): jaccard(sets[a], sets[b]) for a, b in itertools.combinations(range(40), 2) if jaccard(sets[a], sets[b]) > 0.5}


def test_tokens_and_pairs_that_only_share_some_are_not_written(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.sample([f"w{i}" for i in range(200)], 20)) for _ in range(120)]
    texts += [texts[0] + " one", texts[0] + " two"]
    rows = {}

    def counted(df, label):
        out = stage(df, label)
        rows[label] = out.count()
        return out

    monkeypatch.setattr(simjoin, "stage", counted)
    _, found = similar(spark, texts, 20_000)
    assert found == {(0, 120): 20 / 21, (0, 121): 20 / 21, (120, 121): 20 / 22}
    assert rows and max(rows.values()) <= len(texts), rows


def test_sets_meet_across_blocks_and_tokens_of_one_number_cost_no_pair(spark, monkeypatch):
    whole = simjoin.token_codes
    monkeypatch.setattr(simjoin, "token_codes", lambda *a: whole(*a).withColumn("codes", F.transform("codes", lambda x: F.pmod(x, F.lit(16)))))
    for name, small in {"BLOCK_TOKENS": 60, "LEAST_TOKENS": 20, "MEET": 7, "WORDS": 64, "COMMON_FROM": 3}.items():
        monkeypatch.setattr(simjoin, name, small)
    rng = random.Random(8)
    base = [rng.sample([f"w{i}" for i in range(90)], n) for n in (3, 8, 8, 20, 40, 70)]
    texts = [" ".join([w for w in rng.choice(base) if rng.random() < 0.8] + [f"own{i}"]) for i in range(90)]
    sets = [set(t.split()) for t in texts]
    want = {(a, b): s for a, b in itertools.combinations(range(len(texts)), 2) if (s := jaccard(sets[a], sets[b])) > 0.5}
    _, found = similar(spark, texts, 20_000)
    assert len(want) > 100 and found == want


def test_rows_that_come_twice_keep_their_pairs(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d f"), (3, "a b c d f"), (4, None), (5, "!"), (None, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join(docs, "doc_id", text.tokens("text")).collect())
    assert got == [(1, 2, 4 / 6, 3, 2), (2, 3, 1.0, 2, 2)]


def test_word_counts_compare_plain_words():
    """Entries of places or counts are only sorted where their order is asked for, and never by a compare function."""
    assert "array_sort" not in text.similarity_v2("a", "b") + text.keywords("a", "v2")
    assert "sort_array(regexp_extract_all" in text.similarity_v2("a", "b")


def test_each_text_is_cut_into_words_once_for_a_score(spark):
    assert text.similarity_v1("a", "b").count("regexp_extract_all") == 2
    rows = [(1, "a b b", "b c"), (2, None, "x"), (3, "", ""), (4, "!", "a"), (5, "A a", "a"), (6, "x", None)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = {r["i"]: r["s"] for r in df.selectExpr("i", f"{text.similarity_v1('a', 'b')} s").collect()}
    assert got == {1: 1 / 3, 2: 0.0, 3: 0.0, 4: 0.0, 5: 1.0, 6: 0.0}


def test_pair_scores_move_a_row_for_a_document_not_for_a_word(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "b c"), (3, None), (4, "!"), (5, "c"), (5, "b")], "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 2), (1, 2), (2, 3), (3, 4), (2, 5), (5, 9)], "doc_a long, doc_b long")
    scored = text_jobs.text_similarity_pairs(docs, pairs, "v2")
    assert "explode(regexp" not in scored._jdf.queryExecution().toString() and len(scored.collect()) == 5
    got = {(r["doc_a"], r["doc_b"]): r["similarity"] for r in scored.collect()}
    assert got == {(1, 2): round(2 * 2 / (5 ** 0.5 * 2 ** 0.5), 4), (2, 3): 0.0, (3, 4): 0.0, (2, 5): 1.0}


def test_more_baskets_and_pairs_get_more_tasks(spark):
    lines = [(o, p) for o in range(200) for p in range(o % 4)]
    df = spark.createDataFrame(lines + [(None, 1), (None, 2)], "order_id long, product_id long")
    few, many = features.copurchase_pairs(df), features.copurchase_pairs(df, task_rows=20)
    assert sorted(few.collect()) == sorted(many.collect())
    assert {r["together"] for r in many.collect()} == {100, 50} and parts_for(spark, 10**8) == 100
    # no task groups more baskets or pairs than its share
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().toString()
