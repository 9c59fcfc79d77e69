"""Stages of the pipeline on tables with columns of any name."""

import pytest

import corpus_pipeline

CLASHING = ["_old", "_gone", "_digest", "leads", "gone", "digest", "old_text", "_score", "score", "_predicted", "_held_out", "removed_spans", "first_doc_ids", "row", "found", "done", "node", "n", "root", "base", "spans", "_base", "_spans", "random"]
NAMED = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    prose = "the ferryman keeps a list of every heron that nests below the weir and of the stones under each bridge that nobody else has counted since the flood of the year before last in the village of the mill "
    texts = [prose * 2 + "one", prose * 2 + "two", None, "", "", "short", f"key api_key=Zx81kQ0vB7 {prose[:60]}", prose * 3]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + [(5, "short", "en", "s", 5), (None, "no id", None, None, None)]
    extra = [f"concat('{c}:', coalesce(doc_id, -1)) AS `{c}`" for c in CLASHING]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *extra)


@pytest.mark.parametrize("name", ["toxicity", "near_duplicates", "repeated_passages", "secrets"])
def test_other_columns_come_back_unchanged(spark, docs, name):
    got = NAMED[name](spark, docs, "/root/testdata/sf0.001")
    assert got.columns == docs.columns
    rows = got.collect()
    for r in rows:
        assert [r[c] for c in CLASHING] == [f"{c}:{-1 if r.doc_id is None else r.doc_id}" for c in CLASHING]
        assert r.n_chars == len(r.text or "") or r.doc_id is None
    kept = sorted(-1 if r.doc_id is None else r.doc_id for r in rows)
    assert kept == ([-1, 0, 2, 5, 6] if name == "near_duplicates" else [-1, 0, 1, 2, 3, 4, 5, 5, 6, 7])
    if name == "secrets":
        assert [r.text[:12] for r in rows if r.doc_id == 6] == ["key [secret]"]


@pytest.mark.parametrize("name", NAMED)
def test_empty_tables(spark, docs, name):
    assert NAMED[name](spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
