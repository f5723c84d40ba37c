"""The pipeline's stages on a small corpus, each against what is known of it."""

from pyspark.sql import functions as F

import corpus_pipeline
from subscope.llm.queries import documents
from tests.llm.conftest import BASE, Groups, similar_pairs
from tests.llm.test_documents import counts_of, shingle_set


def test_stages(spark, small, tmp_path):
    docs = documents(spark, small)
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == set(before)
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "quality rules":
            for k in gone:
                n_words, *_, n_repeat = counts_of(before[k])
                assert n_words < 50 or 2 * n_repeat > n_words
        if name == "language":
            assert not gone
        if name == "exact duplicates":
            first = {}
            for k in sorted(before):
                first.setdefault(before[k], k)
            assert set(after) == set(first.values())
        if name == "near duplicates":
            keys = sorted(before)
            groups = Groups(keys)
            for a, b in similar_pairs([shingle_set(before[k], 5) for k in keys], 80):
                groups.link(keys[a], keys[b])
            assert set(after) == {groups.find(k) for k in keys}
        before = after


def test_stages_take_empty_tables(spark, small):
    docs = documents(spark, small).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_one_row_of_a_text_stays(spark, awkward, small):
    stage = dict(corpus_pipeline.STAGES)["exact duplicates"]
    before = awkward.select("doc_id", "text").collect()
    after = stage(spark, awkward, small)
    assert after.columns == awkward.columns
    kept = [(r.text or "", r.doc_id) for r in after.collect()]
    first = {}
    for r in before:
        first.setdefault(r.text or "", []).append(r.doc_id)
    assert sorted(map(str, kept)) == sorted(
        str((t, min((k for k in ks if k is not None), default=None))) for t, ks in first.items()
    )


def test_rows_are_dropped_one_by_one(spark, small):
    stages = dict(corpus_pipeline.STAGES)
    schema = "doc_id long, text string, lang string, source string"
    x, y = BASE, BASE.replace("word", "other")
    near = [(5, x), (6, x + " x"), (3, y), (5, y + " y"), (None, y + " z"), (8, "alone " * 9), (None, "null alone")]
    near += [(9, "copied twice over"), (9, "copied twice over")]
    df = spark.createDataFrame([(k, t, "en", "a") for k, t in near], schema)
    found = stages["near duplicates"](spark, df, small)
    assert found.columns == df.columns
    want = [(5, x), (3, y), (8, "alone " * 9), (None, "null alone"), (9, "copied twice over")]
    assert sorted(map(str, ((r.doc_id, r.text) for r in found.collect()))) == sorted(map(str, want))

    rows = [(1, "12 34", "en"), (1, BASE, "en"), (None, "--", "en"), (None, "some words of a text", "en")]
    df = spark.createDataFrame([(*r, "a") for r in rows], schema)
    found = stages["language"](spark, df, small)
    assert {(r.doc_id, r.text) for r in found.collect()} == {(1, BASE), (None, "some words of a text")}


def test_nothing_learnt_drops_no_letters(spark, small):
    df = spark.createDataFrame([(1, "words", None, "a"), (2, "été", None, "a"), (3, "12", None, "a")], "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in dict(corpus_pipeline.STAGES)["language"](spark, df, small).collect()} == {1, 2}


def test_stages_keep_columns_of_any_name(spark, awkward, small):
    names = ["row", "maybe", "_row", "_maybe", "_again", "_id", "_sha", "_text", "_kept", "_place", "_block", "_lines", "_who"]
    df = awkward.select("doc_id", "text", "lang", "source", "who", "kept")
    for name in names:
        df = df.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, df, small)
        assert found.columns == df.columns
        for r in found.collect():
            assert all(r[c] == (None if r.doc_id is None else f"{c}{r.doc_id}") for c in names) and r.who == r.doc_id == r.kept


def test_long_texts_reach_workers_in_small_batches(spark, small):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    docs = spark.range(0, 4000, 1, 1).selectExpr("id as doc_id", "repeat('some words ', 1000) as text", "'a' as source", "'en' as lang")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    for given, most in ((None, 6 << 20), (1 << 20, 2 << 20)):
        spark.conf.unset(name)
        if given:
            spark.conf.set(name, str(given))
        corpus_pipeline.quality(spark, docs, small)
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < most
    spark.conf.unset(name)
