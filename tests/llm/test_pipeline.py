"""The pipeline, each stage judged on its own input, and the registered queries."""

import corpus_pipeline
from helpers import DOCS, SF001, frame, jaccard_groups, odd_rows, removed
from test_others import expected_hits

import __spark_entry__
from adoptlens.llm import quality
from adoptlens.llm.tables import read, stored


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_each_stage_on_its_own_input(spark):
    docs = read(spark, SF001, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name, stage in list(stages.items())[:4]:
        out = stored(stage(spark, docs, SF001), "stage")
        assert out.columns == docs.columns
        kept[name] = rows_of(docs), rows_of(out)
        docs = out
    before, after = kept["quality classifier"]
    model = quality.train(read(spark, SF001, "documents"), read(spark, SF001, "labels"))
    scores = quality.score(read(spark, SF001, "documents"), model).collect()
    assert {i for i, _ in after} == {r.doc_id for r in scores if r.predicted} < {i for i, _ in before}
    before, after = kept["n-gram Jaccard join"]
    component, _ = jaccard_groups(before, 5, 80)
    assert {i for i, _ in after} == set(component)
    before, after = kept["suffix-array dedup"]
    want = {}
    for (i, text), (w, gone) in zip(before, removed(before, 50, lambda t: list((t or "").encode()))):
        rest = bytes(x for x, g in zip(w, gone) if not g).decode("utf-8", "ignore") if any(gone) else text
        if not any(gone) or rest.strip():
            want[i] = rest
    assert dict(after) == want
    before, after = kept["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in read(spark, SF001, "benchmark").collect()]
    assert {i for i, _ in after} == {x[0] for x in expected_hits(before, items) if not x[-1]} < {i for i, _ in before}
    pieces = stored(stages["packing"](spark, docs, SF001), "stage")
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {i for i, _ in after}
    run = corpus_pipeline.run(spark, SF001)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, run.select(columns).collect())) == sorted(map(tuple, pieces.select(columns).collect()))


def test_stages_take_odd_and_empty_tables(spark):
    for rows in (odd_rows(), []):
        docs = frame(spark, rows, DOCS).selectExpr("*", "1 AS score", "'x' AS spans", "2 AS sig")
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, SF001)
            assert out.columns == docs.columns and out.count() <= len(rows)
        assert (corpus_pipeline.STAGES[4][1](spark, docs, SF001).count() > 0) == bool(rows)


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10 and "pipeline" in names
