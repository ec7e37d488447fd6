"""The corpus pipeline, stage by stage, on a small folder."""

import public_tokenizers
import pytest

import corpus_pipeline
from stallkeeper.llm import quality
from stallkeeper.session import stage

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from stallkeeper.llm.common import table

    docs, out = table(spark, SF_DIR, "documents"), []
    for _, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, SF_DIR), "step")
        out.append((before, docs))
    return out


def test_stages_keep_the_columns_and_take_effect(spark, stages):
    columns = stages[0][0].columns
    assert [after.columns for _, after in stages[:-1]] == [columns] * 4
    sizes = [before.count() for before, _ in stages] + [stages[-1][1].count()]
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] == sizes[5]


def test_each_stage_on_its_own_input(spark, stages):
    from stallkeeper.llm.common import table

    (docs, good), (_, distinct), (_, clean), (_, blotted), (_, encoded) = stages
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    model = quality.fit(docs, table(spark, SF_DIR, "labels"))
    assert ids(good) == ids(quality.quality_scores(docs, model).filter("predicted = 1"))
    from tests.llm.test_near_duplicates import linked, shingles, smallest

    sets = {r["doc_id"]: shingles(r["text"]) for r in good.collect()}
    assert ids(distinct) == {i for i, low in smallest(linked(sets), sets).items() if i == low}
    from tests.llm.test_text_search import base_spans, contaminated

    texts = [(r["doc_id"], r["text"]) for r in distinct.collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    assert ids(clean) == {r[0] for r in contaminated(texts, items) if not r[-1]}
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in blotted.collect():
        assert not base_spans(r["text"]) and (r["text"] == before[r["doc_id"]]) == (not base_spans(before[r["doc_id"]]))
        assert r["n_chars"] == len(r["text"])
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    last = {r["doc_id"]: r["text"] for r in blotted.collect()}
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {i: own.encode(t) for i, t in last.items()}


@pytest.mark.parametrize("name,step", corpus_pipeline.STAGES)
def test_odd_rows_and_empty_tables(spark, documents, odd, name, step):
    """Null and empty texts, repeated rows and rows without id pass every stage; columns with clashing names stay."""
    docs = documents([*odd, (50, "plain words of a clean text")])
    out = step(spark, docs, SF_DIR)
    kept = out.collect()
    assert len(kept) <= len(odd) + 1 and {r["doc_id"] for r in kept} <= {1, 2, 3, 4, 5, 50, None}
    if (name, step) != corpus_pipeline.STAGES[-1]:
        assert out.columns == docs.columns
    if name not in (corpus_pipeline.STAGES[0][0], corpus_pipeline.STAGES[1][0]):
        assert len(kept) == len(odd) + 1
    assert step(spark, documents([]), SF_DIR).count() == 0


def test_texts_go_to_the_workers_in_small_batches(spark, documents):
    import pyarrow as pa

    from stallkeeper.llm.common import BATCH_KEY

    rows = documents([(i, f"text number {i} of many") for i in range(3_000)]).coalesce(1).select("doc_id", "text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    for _, step in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[-1:]:
        spark.conf.unset(BATCH_KEY)
        step(spark, documents([(1, "one"), (2, "two")]), SF_DIR)
        assert [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()] == [1_000] * 3
    spark.conf.set(BATCH_KEY, "2500")  # the caller's own number stays
    corpus_pipeline.encoded(spark, documents([(1, "one")]), SF_DIR)
    assert max(r["n"] for r in rows.mapInArrow(sizes, "n long").collect()) == 2_500
    spark.conf.unset(BATCH_KEY)


def test_near_duplicates_leave_no_tables_behind(spark, documents):
    import os

    from stallkeeper.session import staging_root

    root = staging_root(spark).removeprefix("file://")
    rows = [(i, f"one two three four five six seven eight nine ten {'end' * (i % 2)}") for i in range(8)]
    before = set(os.listdir(root))
    out = corpus_pipeline.distinct_documents(spark, documents(rows), SF_DIR)
    assert [x.split("-")[0] for x in set(os.listdir(root)) - before] == ["kept"]
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 1] or len(out.collect()) == 1
