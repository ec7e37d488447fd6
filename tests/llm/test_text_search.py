"""Decontamination, secrets and substring deduplication against plain Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from stallkeeper.llm import chunk_dedup, decontaminate, secret_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def contaminated(docs, items, size=13):
    wins = {}
    for item, text in items:
        w = WORD.findall(fold(text))
        for s in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[s:s + size]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = WORD.findall(fold(text)), set(), set()
        for p, ids in wins.items():
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s:s + len(p)]) == p:
                    hit.update(range(s, s + len(p)))
                    found.update(str(x) for x in ids if x is not None)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_contamination_matches_brute_force(spark, documents, odd):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(12)] + ["Écu", "écu", "İx", "ẞa"]
    item = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(1, item(20)), (2, item(14)), (3, item(5)), (3, item(5)), (4, None), (5, "..."), (None, item(13)), (10, "W1 w1 w1"), (10, "W1 w1 w1")]
    texts = [t for _, t in items if t]
    docs = [(100 + k, " ".join([item(30), rng.choice(texts).upper() if k % 3 else rng.choice(texts), item(10)])) for k in range(30)] + odd + [
        (500, "w1 " * 40), (501, texts[0]), (502, texts[0] + " " + texts[0])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    for keys in (1, 3):
        got = decontaminate.contamination(documents(docs), bench, keys=keys).drop("version")
        assert rows(got) == sorted(contaminated(docs, items), key=repr)


def test_capital_sigma_before_signs(spark, documents):
    text = " ".join(f"w{k}" for k in range(11)) + " ΛΟΓΟΣ.ΑΛΛΟΣ:b"
    items, docs = [(1, text)], [(1, f"x {text} y"), (2, text.replace(".", " ")), (3, text.lower())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(docs), bench).drop("version")
    assert rows(got) == sorted(contaminated(docs, items), key=repr) and sum(r["n_hit"] > 0 for r in got.collect()) == 2


def test_contamination_of_empty_tables(spark, documents, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.contamination(documents(odd), none).collect()} == {0}
    assert decontaminate.contamination(documents([]), none).count() == 0
    assert decontaminate.uncontaminated(documents(odd), none).count() == len(odd)


def test_whole_index_and_proximity(documents):
    index = decontaminate.build_index(documents([(1, "a b c a"), (2, "c x x a"), (None, "a c")]))
    assert index.count() == 10
    near = {(r["doc_id"], r["pos"], r["other"]) for r in decontaminate.proximity(index, "a", "c", 2).collect()}
    assert near == {(1, 0, 2), (1, 3, 2), (None, 0, 1)}


def test_decontaminated_rows_keep_their_columns(spark, documents):
    text = " ".join(f"q{k}" for k in range(15))
    docs = documents([(1, text), (1, "other words"), (2, "clean text"), (None, text)])
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    kept = decontaminate.uncontaminated(docs, bench)
    assert kept.columns == docs.columns and rows(kept.select("doc_id", "text")) == [(1, "other words"), (2, "clean text")]


def base_spans(text):
    t = text or ""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_spans_match_brute_force(documents, odd):
    hexed = "0123456789abcdef" * 2
    docs = odd + [(10, f"é🙂 PassWord = 'abcdefgh' token:short12 x{hexed}y {hexed}a AKIAABCDEFGHIJKL AKIASHORT"), (11, "secret=secret=12345678 api_key: a.b-c_d/e"),
                  (12, "token=" + "a1" * 30 + " " + hexed), (13, "a" * 5000 + " passwd=ab " * 50), (14, hexed * 40 + "g" + hexed)]
    got = secret_scan.secret_report(documents(docs)).collect()
    want = sorted((repr(i), hashlib.sha256(base_spans(t).encode()).hexdigest()) for i, t in docs)
    assert sorted((repr(r["doc_id"]), r["base_sha256"]) for r in got) == want
    for r in got:
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == sum(not s.startswith("random") for s in r["spans"].split(",") if s)
    assert secret_scan.secret_report(documents([])).count() == 0


def test_random_strings_are_found_and_words_are_not(documents):
    import base64

    rng = random.Random(8)
    keys = [base64.b64encode(rng.randbytes(36)).decode() for _ in range(30)]
    plain = ["antidisestablishmentarianism2024", "release-notes-of-version-12-final", "aaaaaaaaaaaaaaaaaaaa1111111111111111", "2024010120240102202401032024"]
    docs = [(k, f"see {key} there") for k, key in enumerate(keys)] + [(100 + k, f"the {p} of donaudampfschifffahrtsgesellschaft") for k, p in enumerate(plain)]
    found = {r["doc_id"] for r in secret_scan.secret_report(documents(docs)).filter("spans like '%random%'").collect()}
    assert len(found & set(range(30))) >= 27 and not found & set(range(100, 110))


def test_battery_flags_non_random_strings(spark):
    values = ["0123456789abcdef0123456789abcdef", "00000000000000001111111111111111", "9f86d081884c7d659a2feaa0c55ad015"]
    got = {r["value"]: r["p_random"] for r in secret_scan.battery(spark.createDataFrame([(v,) for v in values], "value string")).collect()}
    assert got[values[1]] < 0.001 < 0.01 < got[values[2]] and got[values[0]] < got[values[2]]


def test_redaction_cuts_spans_and_keeps_columns(documents, odd):
    docs = documents(odd + [(20, "a password=abcdefgh1 b AKIAABCDEFGHIJKL"), (21, "token=" + "0123456789abcdef" * 2 + " end")])
    out = secret_scan.redacted(docs)
    assert out.columns == docs.columns and out.count() == len(odd) + 2
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.filter("doc_id >= 20").collect()}
    assert got == {20: ("a [SECRET] b [SECRET]", 21), 21: ("[SECRET] end", 12)}
    assert rows(out.filter("doc_id < 20 or doc_id is null").select("doc_id", "text")) == sorted(odd, key=repr)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))


def test_planted_passages_are_found_and_clean_texts_are_not(documents, odd):
    rng = random.Random(6)
    passages = [words(rng, 60) for _ in range(40)]
    holders = [(k, f"{words(rng, 40 + k)} {passages[k % 40]}{'!' * (k % 3)} {words(rng, 30)}") for k in range(80)]
    clean = [(200 + k, words(rng, 200)) for k in range(40)]
    got = chunk_dedup.repeated_passages(documents(holders + clean + odd)).collect()
    assert {r["doc_id"] for r in got} == set(range(80))
    texts = dict(holders)
    for r in got:
        assert r["first_doc_id"] == r["doc_id"] % 40 and texts[r["doc_id"]][r["start"]:r["end"]].strip("! ") in texts[r["first_doc_id"]]
    kept = {r["doc_id"]: r["text"] for r in chunk_dedup.deduplicated(documents(holders + clean)).collect()}
    assert all(kept[k] == texts[k] for k in range(40)) and all(len(kept[k]) < len(texts[k]) - 150 for k in range(40, 80))


def test_chunks_cover_the_text_and_survive_insertions(documents):
    rng = random.Random(1)
    text = words(rng, 800) + " é🙂" + "z" * 3000
    found = chunk_dedup.chunks(documents([(1, text), (2, "inserted " + text)])).orderBy("doc_id", "seq").collect()
    one, two = ([r for r in found if r["doc_id"] == k] for k in (1, 2))
    assert one[0]["start"] == 0 and one[-1]["end"] == len(text) and all(a["end"] == b["start"] for a, b in zip(one, one[1:]))
    assert sum(r["words"] for r in one) == len(text.split())
    shared = {r["digest"] for r in one} & {r["digest"] for r in two}
    assert len({r["digest"] for r in one}) - len(shared) <= 20  # the start, and the run cut by length


def test_passages_of_empty_table_and_odd_rows(documents, odd):
    assert chunk_dedup.repeated_passages(documents([])).count() == 0
    assert chunk_dedup.deduplicated(documents(odd)).count() == len(odd)
    long = "x y z " * 3000
    got = chunk_dedup.repeated_passages(documents([(1, long), (1, long), (2, long)])).agg(F.collect_set("doc_id")).first()[0]
    assert sorted(got) == [1, 2]


def shared_runs(docs, size):
    """(doc_id, start, end) of all passages, by comparing the text of every run of words."""
    strip = re.compile(r"[^0-9A-Za-z\x80-\U0010ffff]*(.*?)[^0-9A-Za-z\x80-\U0010ffff]*", re.S)
    runs, held = {}, {}
    for i, text in docs:
        w = [(m.start(), m.end()) for m in re.finditer(r"[^\t\n\x0b\x0c\r ]+", text)]
        inner = [strip.fullmatch(text[a:b]).span(1) if strip.fullmatch(text[a:b])[1] else (0, b - a) for a, b in w]
        runs[i] = [(w[k][0] + inner[k][0], w[k + size - 1][0] + inner[k + size - 1][1]) for k in range(len(w) - size + 1)]
        for a, b in runs[i]:
            held.setdefault(text[a:b], set()).add(i)
    out = []
    for i, text in docs:
        before = None
        for k, (a, b) in enumerate(runs[i]):
            if len(held[text[a:b]]) > 1:
                out[-1:] = [(i, out[-1][1], b)] if before == k - 1 else [*out[-1:], (i, a, b)]
                before = k
    return sorted(out)


def test_passages_of_exactly_51_words_match_brute_force(documents):
    rng = random.Random(7)
    letters = lambda n, size: " ".join("".join(rng.choices("abcdefghij", k=size)) for _ in range(n))
    docs, want = [], set()
    for k in range(120):
        size = (1, 2, 3, 5)[k % 4]
        passage = letters(51 if k % 3 else 50, size) if k % 5 else " ".join(["la", "lala"][k % 2] for _ in range(51 if k % 3 else 50))
        if k % 5 == 0:
            passage = f"k{k} {passage[:passage.rindex(' ')]}"
        for copy in range(2):
            docs.append((2 * k + copy, f"{letters(30, 7)} {'(' * copy}{passage}{'.)' * copy}\n{letters(20 + k, 6)}"))
            want |= {2 * k + copy} if k % 3 else set()
    line = letters(9, 4)
    docs += [(1000, f"{letters(3, 5)}\n" + f"{line}\n" * 12), (1001, f"{line}\n" * 7 + letters(60, 5)), (1002, f"{line}\n" * 5 + letters(60, 5)),
             (1003, "é " * 70), (1004, "é " * 60 + "ü"), (1005, "z" * 900 + " z" * 49), (1006, "z" * 900 + " z" * 49)]
    got = chunk_dedup.repeated_passages(documents(docs)).collect()
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in got) == shared_runs(docs, 51)
    assert {r["doc_id"] for r in got} == want | {1000, 1001, 1003, 1004}
    texts = dict(docs)
    assert all(r["n_words"] == len(texts[r["doc_id"]][r["start"]:r["end"]].split()) for r in got)


def test_parts_of_a_passage_held_by_different_documents(documents):
    rng = random.Random(9)
    docs = [(k, words(rng, 120)) for k in range(6)]
    w = docs[5][1].split()
    docs += [(10, " ".join(w[:45])), (11, " ".join(w[40:90])), (12, " ".join(w[30:85])), (13, "x " + " ".join(w[30:85]) + " y")]
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in chunk_dedup.repeated_passages(documents(docs)).collect()) == shared_runs(docs, 51)
    for size in (1, 2, 7):
        few = [(k, t[:60]) for k, t in docs]
        assert sorted((r["doc_id"], r["start"], r["end"]) for r in chunk_dedup.repeated_passages(
            documents(few), min_words=size).collect()) == shared_runs(few, size)


def test_texts_are_cut_into_words_once(documents, monkeypatch):
    cuts = []
    plain = decontaminate.raw_words
    monkeypatch.setattr(decontaminate, "raw_words", lambda text: (cuts.append(1), plain(text))[1])
    bench = documents([(1, "x")]).sparkSession.createDataFrame([("i", "Alpha beta")], "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontaminate.contamination(
        documents([(1, "an ALPHA beta \u0130x 9"), (2, None), (3, "beta alpha")]), bench).collect()}
    assert got == {1: (5, 2), 2: (0, 0), 3: (2, 0)} and len(cuts) == 1
