"""The pipeline against stages built from brute force, and its registration."""

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gapseries.llm import langid, spm
from gapseries.llm.common import load, materialise
from gapseries.llm.q_corpus import PIECES

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "repeated_passages", "decontaminate", "tokenise"]


def test_pipeline_equals_brute_force(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    docs = load(spark, SMALL, "documents")
    langs = {r.doc_id: (r.lang_pred, r.fit) for r in langid.identify(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if langs[r.doc_id][0] != "und" and langs[r.doc_id][1] > 0]
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, brute.simhash_rows(rows)) if i == c]
    rows = [(i, " ".join(kept) if gone else t) for (i, t), (_, _, gone, _, kept) in zip(rows, brute.repeats(rows)) if kept or not gone]
    items = [(r.item_id, r.text) for r in load(spark, SMALL, "benchmark").collect()]
    rows = [(i, t) for (i, t), hit in zip(rows, brute.contamination(rows, items)) if not hit[2]]
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((i, lib.encode(t)) for i, t in rows)
    assert all(r.round_trip for r in got) and 0 < len(got) < docs.count()


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_edge_cases(spark, empty):
    docs = brute.edge_docs(spark).select(*corpus_pipeline.COLUMNS)
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SMALL), name)
        assert docs.count() <= before.count()
        if name != "tokenise":
            assert docs.columns == corpus_pipeline.COLUMNS
    if not empty:
        assert {None, 7, 16} <= {r.doc_id for r in docs.collect()}


def test_decontaminate_judges_null_ids(spark):
    """Every row goes by its own text, whatever its id."""
    item = load(spark, SMALL, "benchmark").first().text
    rows = [(None, "before " + item + " after"), (None, "clean words"), (1, item), (1, "other clean words"), (2, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.decontaminate(spark, docs, SMALL)
    assert got.columns == corpus_pipeline.COLUMNS
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([rows[1], *rows[3:]], key=str)


def test_rows_of_one_id_keep_their_own_texts(spark):
    """A copy or a repeat in one row takes nothing from another row of its id; equal rows share one result."""
    copy, passage = "one two three four five six seven eight nine ten", " ".join(f"p{i}" for i in range(60))
    own = " ".join(f"q{i}" for i in range(70))
    rows = [(1, copy), (2, copy), (2, own), (3, passage), (4, passage), (4, "x " + passage + " y"), (4, "x " + passage + " y"),
            (4, "nothing repeated here")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    read = lambda df: sorted((r.doc_id, r.text, r.n_chars) for r in df.collect())
    got = read(corpus_pipeline.near_duplicates(spark, docs.where("doc_id < 3"), SMALL))
    assert got == sorted((i, t, len(t)) for i, t in (rows[0], rows[2]))
    got = read(corpus_pipeline.repeated_passages(spark, docs.where("doc_id > 2"), SMALL))
    assert got == sorted((i, t, len(t)) for i, t in (rows[3], (4, "x y"), (4, "x y"), rows[7]))


def test_clashing_columns_pass_all_stages(spark):
    """Extra columns with the names that the operators use inside keep their values."""
    from pyspark.sql import functions as F
    docs = load(spark, SMALL, "documents").limit(300)
    names = ["kept_text", "score", "lang_pred", "fit", "_key", "_row", "_one", "row", "id", "carried", "_maybe", "component_id", "open", "fp"]
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = materialise(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
    assert docs.count() > 0
    for name in names:
        assert docs.where(F.col(name) != F.concat(F.lit(name), F.col("doc_id").cast("string"))).count() == 0


def test_scratch_goes_with_the_next_stage(spark, tmp_path):
    """Tables of a stage are there until the next one starts, which may not read them itself."""
    import os
    docs = load(spark, SMALL, "documents")
    lazy = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    kept = list(corpus_pipeline._left)
    assert kept and all(os.path.isdir(p) for p in kept)
    cut = corpus_pipeline.repeated_passages(spark, lazy, SMALL)      # reads the tables of the stage before
    assert cut.count() > 0
    corpus_pipeline.decontaminate(spark, docs, SMALL)
    assert not any(os.path.isdir(p) for p in kept)


@pytest.mark.parametrize("max_bytes", [4096, 1 << 20])
def test_drop_matching(spark, max_bytes):
    """As a left-anti join, nulls included, also with a filter that is full."""
    from gapseries.llm.keyfilter import drop_matching
    rows = spark.range(60_000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id END AS a", "cast(id % 5 AS string) AS b", "id AS _maybe")
    gone = spark.range(0, 60_000, 3).selectExpr("id AS a", "cast(id % 5 AS string) AS b").union(spark.createDataFrame([(None, "1")], "a long, b string"))
    got = drop_matching(rows, gone, ["a", "b"], max_bytes)
    want = rows.join(gone, ["a", "b"], "left_anti").select(*rows.columns)
    assert got.columns == rows.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert drop_matching(rows, gone.limit(0), ["a", "b"]).count() == 60_000


def test_model_path_is_read(spark):
    assert len(spm.read_model(PIECES)) > 1000
