"""Classifiers on held-out rows, token counts, encodings and token files."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stallkeeper.llm import lattice, quality, token_count, token_files, toxicity
from stallkeeper.llm.common import slices

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "  ", " ", "\n", "\t", "é", "<|endoftext|>", "'s", "12", "!", "\x1c", "\xa0", "漢", "🙂", "   ", " x", "the ", ".", "\x00", "x" * 70]


def noise(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(n)]


def sp():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def labelled(spark, documents):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("aeioulmnrst", k=rng.randint(2, 7)))
    docs, labels = [], []
    for i in range(900):
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.6)
        w = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(2, 4) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["grumbos", "Grumb0", "zlurky", "zIurky", "zlurkier", "gruмbos"]))
        if rng.random() < 0.2 and not toxic:
            w.insert(3, "zlurky cake")  # harmless phrase
        text = " ".join(w)
        docs.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, good, toxic))
    return documents(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scored, labels, label):
    r = scored.join(labels, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()
    assert r[1] > 100
    return r[0]


def test_toxicity_learns_lexicon_and_exceptions(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    assert any(t.startswith(" grum") for t in model["lexicon"]) and " zlurky  cake " in model["exceptions"]
    assert accuracy(toxicity.toxicity_scores(docs, model), labels, "toxic") > 0.95


def test_folding():
    assert toxicity.folded_words("Gr0ß! 1d10t-Мoron ÀÉ ﬁn") == ["gross", "idiot", "moron", "ae", "fin"]
    assert toxicity.folded_words("") == []


def test_quality_discriminant(labelled):
    docs, labels = labelled
    assert accuracy(quality.quality_scores(docs, quality.fit(docs, labels)), labels, "quality") > 0.95


def test_mahalanobis_difference_against_inverse_covariances():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(80, 5)), rng.normal(1, 2, size=(60, 5))])
    y = np.r_[np.zeros(80, int), np.ones(60, int)]
    m = quality.discriminant(x, y)
    z = np.clip((x - m["centre"]) / m["scale"], -6, 6)
    dens = []
    for mean, inverse, log_det in m["classes"]:
        cov = np.linalg.inv(inverse.T @ inverse)
        d = z - mean
        dens.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(quality.log_density_difference(m, x), dens[1] - dens[0])


def test_scores_of_odd_rows_and_missing_labels(spark, documents, odd, labelled):
    docs, labels = labelled
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bad = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 7, 7), (4, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    for fit, score in ((toxicity.fit, toxicity.toxicity_scores), (quality.fit, quality.quality_scores)):
        for given in (none, bad):
            got = score(documents(odd), fit(documents(odd), given)).collect()
            assert len(got) == len(odd) and all(0 <= r["score"] <= 1 for r in got) and not [r for r in got if r["doc_id"] is None and r["held_out"]]
        got = score(documents(odd), fit(docs, labels)).collect()
        assert len(got) == len(odd) and all(0 <= r["score"] <= 1 for r in got)
        assert score(documents([]), fit(docs, labels)).count() == 0


def test_held_out_labels_are_not_learned(spark, labelled):
    docs, labels = labelled
    kept = {r["doc_id"] for r in quality.training_labels(labels, "quality", 3, 1, 10_000).collect()}
    assert kept == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert quality.training_labels(labels, "quality", 3, 1, 50).count() == 50


def test_a_repeated_id_is_fitted_once(spark, documents, labelled, monkeypatch):
    docs, labels = labelled
    hot = next(i for i in range(900) if zlib.crc32(str(i).encode()) % 12 not in (1, 2, 4, 6, 7, 10))
    many = docs.unionByName(documents([(hot, f"one of many texts {k}") for k in range(500)]))
    seen, discriminant, logistic = [], quality.discriminant, toxicity.logistic
    monkeypatch.setattr(quality, "discriminant", lambda x, y: (seen.append(len(y)), discriminant(x, y))[1])
    monkeypatch.setattr(toxicity, "logistic", lambda x, y: (seen.append(len(y)), logistic(x, y))[1])
    quality.fit(many, labels)
    toxicity.fit(many, labels)
    crc = [zlib.crc32(str(i).encode()) for i in range(900)]
    assert seen == [sum(c % 3 != 1 for c in crc), sum(c % 4 != 2 for c in crc)]


def test_accepted_keeps_columns(labelled, documents, odd):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    kept = quality.accepted(docs, model)
    scored = {r["doc_id"] for r in quality.quality_scores(docs, model).filter("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == scored


def test_token_counts_equal_the_library(documents, odd):
    rng, own = random.Random(2), sp()
    texts = noise(300) + ["word " * 9000, "x" * 50_000, " ".join(noise(600, 9)), "▁a▁ b " * 3000]
    docs = list(enumerate(texts, 100)) + odd
    got = token_count.token_counts(documents(docs), MODEL, limit=50).collect()
    want = [(i, len((t or "").encode()), len(own.encode(t or "")), len(own.encode(t or "")) > 50) for i, t in docs]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    m = token_count.model(MODEL)
    for t in rng.sample(texts[:300], 200):
        assert m.ids(t, 10, 3) == own.encode(t)
    assert token_count.token_counts(documents([]), MODEL).count() == 0


def test_lattice_encoding_and_decoding(documents, odd):
    own = sp()
    docs = list(enumerate(noise(150) + ["w" * 500 + " ab", "1" * 80, "ﬁn² a²."], 100)) + odd
    for chars in (2_000, lattice.BLOCK_CHARS):
        encoded = lattice.encode(documents(docs), MODEL, block_chars=chars)
        got = encoded.collect()
        assert sorted((repr(r["doc_id"]), r["ids"]) for r in got) == sorted((repr(i), own.encode(t or "")) for i, t in docs)
        assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    back = lattice.decode(encoded, MODEL).collect()
    assert sorted((repr(r["doc_id"]), r["text"]) for r in back) == sorted((repr(i), t or "") for i, t in docs)
    assert lattice.encode(documents([]), MODEL).count() == 0


def test_copies_and_full_partitions_fill_several_blocks(spark, documents):
    same = "the same words in all copies of a text " * 5
    rows = documents([(None, same)] * 300 + [(k, f"short {k}") for k in range(110)]).coalesce(1).select("doc_id", "text")
    blocks = {r["home"]: (r["n"], r["chars"]) for r in lattice._homed(rows, 5_000).groupBy("home").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    assert sum(n for n, _ in blocks.values()) == 410 and max(c for _, c in blocks.values()) <= 15_000
    assert len(blocks) > 8
    own = sp()
    got = lattice.encode(rows, MODEL, block_chars=5_000).collect()
    assert len(got) == 410 and sum(r["ids"] == own.encode(same) for r in got) == 300 and all(r["round_trip"] for r in got)


def test_words_are_shuffled_once_and_texts_never(documents, capsys):
    docs = documents([(i, f"some words {i} of a text") for i in range(50)])
    lattice.encode(docs, MODEL).explain()
    plan = capsys.readouterr().out
    assert len(re.findall(r"hashpartitioning\([^)]*\bword#", plan)) <= 1 and not re.search(r"Exchange hash[^\n]*\n[^\n]*Project \[[^\n]*text#", plan)


def test_one_pass_gives_what_the_steps_give(spark):
    own, rng = lattice.pieces(MODEL), random.Random(8)
    odd = own.unordered()
    assert odd == {p for p in odd if set(p) == {"▁"}}  # the runs of blanks share a score
    names = [p for p, _, _ in own.rows if "▁" not in p]
    words = {"▁" + "".join(rng.choices(names, k=3))[:63] for _ in range(300)} | {"▁" * 20 + "ab", "x" * 64, "▁été", "中" * 30, "▁a\u0e01b"}
    table = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    n = F.length("word")
    graph = lattice._merge_edges(table.withColumn("places", F.array(F.lit(1).cast("long"))), MODEL, 64)
    got = graph.filter(n < 64).select("odd", lattice._one_pass(n).alias("x"), lattice._by_steps(n).alias("y")).collect()
    assert len(got) == sum(len(w) < 64 for w in words) and all(r["odd"] or r["x"] == r["y"] for r in got) and sum(r["odd"] for r in got) == 1
    lib = sp()
    want = {w: lib.encode(w[1:].replace("▁", " ")) if w[0] == "▁" else lib.encode("\n" + w)[2:] for w in words}
    assert {r["word"]: r["ids"] for r in lattice.encode_words(table, MODEL).collect()} == want


def test_blocks_read_otherwise_the_second_time(documents):
    texts = [(i, t) for i, t in enumerate(noise(40)) if t]
    slim = documents(texts).select("doc_id", "text").coalesce(1)
    schema = "block long, doc_id long, marks binary, ids array<int>, round_trip boolean"
    got = slim.mapInArrow(lattice._marked(MODEL, 10_000_000, {0: "other words"}), schema).collect()
    own = sp()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: own.encode(t) for i, t in texts} and all(r["marks"] is None and r["round_trip"] for r in got)


def test_numbers_of_all_widths_are_packed():
    x = np.array([0, 127, 128, 16_383, 16_384, 2_097_151, 2_097_152, (1 << 28) - 1])
    data, ends = lattice._packed(x)
    assert lattice._unpacked(data.tobytes()).tolist() == x.tolist() and np.diff(ends, prepend=0).tolist() == [1, 1, 2, 2, 3, 3, 4, 4]


def test_viterbi_fold_is_the_best_path(spark):
    scores = {p: s for p, _, s in lattice.pieces(MODEL).rows}
    names = {i: p for p, i, _ in lattice.pieces(MODEL).rows}
    words = ["▁the", "▁therehat", "▁anatstion", "▁queé", "...", "▁▁▁", "b"]

    def best(w):
        top = [0.0] + [None] * len(w)
        for j in range(1, len(w) + 1):
            top[j] = max(top[i] + scores[w[i:j]] for i in range(j) if w[i:j] in scores)
        return top[-1]

    got = lattice.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), MODEL, "viterbi").collect()
    assert len(got) == len(words)
    for r in got:
        found = [names[i] for i in r["ids"]]
        assert "".join(found) == r["word"] and sum(scores[p] for p in found) == pytest.approx(best(r["word"]))


def test_token_files_hold_the_stream(spark, documents, odd, folder):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    docs = [(1000 - i, t) for i, t in enumerate(noise(200, 3))] + odd
    path = folder("tokens")
    index = token_files.token_file_index(documents(docs), BYTES, path=path)
    ids = lambda t: tok.encode(t or "", add_special_tokens=False).ids + [0]
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    want, start = [], 0
    for i, t in order:
        x = ids(t)
        want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    got = [tuple(r) for r in index.select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert got == want
    files = {r["path"].rsplit("/", 1)[-1]: bytes(r["content"]) for r in spark.read.format("binaryFile").load(f"{path}/records").collect()}
    for r in random.Random(1).sample(index.filter("doc_id > 800").collect(), 20):
        doc_id, found = token_files.read_record(files[r["file"]], r["offset"])
        assert doc_id == r["doc_id"] and found == ids(dict(docs)[doc_id])
    data = bytearray(next(v for v in files.values() if len(v) > 60))
    data[25] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.records(bytes(data)))


def test_one_id_and_null_ids_fill_several_files_of_bounded_size(spark, documents, folder):
    from tokenizers import Tokenizer

    tok, rng = Tokenizer.from_file(BYTES), random.Random(4)
    text = lambda: " ".join(rng.choices(["the", "corner", "of", "a", "house"], k=300))
    same = text()
    docs = [(i, same if k % 3 == 0 else text()) for i in (None, 7) for k in range(300)] + [(k, text()) for k in range(20)]
    path = folder("tokens")
    index = token_files.token_file_index(documents(docs), BYTES, path=path, range_bytes=100_000, bundle_bytes=1000).collect()
    sizes = [r["length"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select("length").collect()]
    assert max(sizes) <= 32 * 1001 and len(sizes) > 10
    for i in (None, 7):
        parts = {r["file"].split("-")[1] for r in index if r["doc_id"] == i}
        assert len(parts) > 2
    crc = lambda t: zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes())
    assert sorted((repr(r["doc_id"]), r["ids_crc32"]) for r in index) == sorted((repr(i), crc(t)) for i, t in docs)
    stream = sorted(index, key=lambda r: r["start"])
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in stream]
    assert ids == sorted(ids) and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(stream, stream[1:]))


def test_token_files_of_an_empty_table(documents):
    assert token_files.token_file_index(documents([]), BYTES).count() == 0


def test_slices_cover_all_rows():
    texts = ["ab" * k for k in range(20)]
    for size in (1, 10, 10_000):
        found = list(slices(texts, size))
        assert [i for a, b in found for i in range(a, b)] == list(range(20))
