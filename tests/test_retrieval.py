import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscope.operators import ann, diff, index, knn, pivots
from subscope.sources import generate
from subscope.streaming import index_sync

VECTORS = "pk bigint, embedding array<float>, genre string"


def brute_force(rows, queries, k, match=False):
    expected = {}
    for q, vector, genre in queries:
        ranked = []
        for pk, other, other_genre in rows:
            if match and genre is not None and genre != other_genre:
                continue
            a, b = np.asarray(vector, np.float32).astype(float), np.asarray(other, np.float32).astype(float)
            if not a.any() or not b.any():
                continue
            ranked.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9), pk))
        expected[q] = [(pk, -s) for s, pk in sorted(ranked)[:k]]
    return {q: hits for q, hits in expected.items() if hits}


def found(hits):
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["pk"], r["score"]))
    return got


def same(got, expected):
    assert got.keys() == expected.keys()
    for q in expected:
        assert [pk for pk, _ in got[q]] == [pk for pk, _ in expected[q]], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in expected[q]], abs=2e-9)


@pytest.fixture(scope="module")
def vectors():
    """Clusters, a group of copies holding a third of the rows, zeros and a lone direction."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 8))
    rows = []
    for pk in range(600):
        if pk % 3 == 0:
            v = centres[0]
        elif pk == 100:
            v = np.zeros(8)
        else:
            v = centres[pk % 6] + 0.3 * rng.normal(size=8)
        rows.append((pk, [float(x) for x in np.float32(v)], None if pk % 50 == 49 else "gh"[pk % 2]))
    return rows


def frames(spark, rows, queries):
    held = spark.createDataFrame(rows, VECTORS).repartition(5)
    asked = spark.createDataFrame(queries, VECTORS).withColumnRenamed("pk", "query_id")
    return held, asked


def test_one_plan_for_any_number_of_queries(spark, vectors):
    shapes = []
    for asked_rows in (vectors[:10], vectors * 40):
        held, asked = frames(spark, vectors, asked_rows)
        hits = knn.search(held, asked, 5, pk="pk", query_id="query_id")
        plan = hits._jdf.queryExecution().optimizedPlan().toString()
        shapes.append(re.findall(r"^[ :+-]*([A-Z]\w+)", plan, re.M))
    assert shapes[0] == shapes[1]


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_exact_search_equals_brute_force(spark, vectors, block_rows):
    held, asked = frames(spark, vectors, vectors)
    hits = knn.search(held, asked, 7, pk="pk", query_id="query_id", block_rows=block_rows)
    same(found(hits), brute_force(vectors, vectors, 7))


def test_filtered_search_equals_brute_force(spark, vectors):
    held, asked = frames(spark, vectors, vectors)
    hits = knn.search(held, asked, 4, pk="pk", query_id="query_id", match="genre", block_rows=32)
    same(found(hits), brute_force(vectors, vectors, 4, match=True))
    only = knn.search(held, asked, 4, pk="pk", query_id="query_id", where=F.col("genre") == "g")
    same(found(only), brute_force([r for r in vectors if r[2] == "g"], vectors, 4))


def test_near_copies_tie_by_key(spark):
    """Rows whose scores differ only past the ninth decimal, spread over many small cells."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=6)
    rows = [
        (pk, [float(x) for x in np.float32(base + 10.0 ** -(3 + pk % 4) * rng.normal(size=6))], None)
        for pk in range(300)
    ]
    held, asked = frames(spark, rows, rows)
    hits = knn.search(held, asked, 5, pk="pk", query_id="query_id", block_rows=4)
    same(found(hits), brute_force(rows, rows, 5))


def test_a_deep_tree_changes_nothing(spark, vectors):
    held, asked = frames(spark, vectors, vectors[:40])
    layout = knn.lay_out(held, "pk", k=3, block_rows=16, cell_rows=3)
    assert len(layout.tree.levels) > 1
    rows = layout.tree.cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius"))
    nodes = layout.tree.levels[0].select(F.explode("children").alias("c")).select("c.*").where("leaf")
    for r in nodes.join(rows.withColumnRenamed("n", "m").withColumnRenamed("radius", "r"), F.col("child") == F.col("cell")).collect():
        assert (r["n"], r["radius"]) == (r["m"], r["r"])
    same(found(knn.search_layout(layout, asked, 3, "query_id")), brute_force(vectors, vectors[:40], 3))


def test_descent_leaves_cells_out(spark, vectors):
    held, asked = frames(spark, vectors, vectors[1:3])
    layout = knn.lay_out(held, "pk", k=3, cell_rows=30)
    cells = layout.tree.cells.select("cell").distinct().count()
    asks = knn.queries_of(asked, "query_id", "embedding", None)
    visited = pivots.descend(layout.tree, asks, pivots.within_reach(3)).groupBy("q").count().collect()
    assert len(visited) == 2 and all(r["count"] < cells / 2 for r in visited)


def test_search_edges(spark):
    rows = [(1, [1.0, 0.0], "g"), (2, [0.0, 0.0], "g"), (3, [1.0, 0.0], "h"), (4, None, "h")]
    asked_rows = [(10, [2.0, 0.0], None), (11, [0.0, 0.0], None), (12, None, None)]
    held, asked = frames(spark, rows, asked_rows)
    hits = knn.search(held, asked, 9, pk="pk", query_id="query_id")
    assert found(hits) == {10: [(1, 1.0), (3, 1.0)]}  # k above the rows; zeros and nulls find nothing
    none = knn.search(held, asked, 9, pk="pk", query_id="query_id", where=F.col("genre") == "nothing")
    assert none.count() == 0 and none.columns == ["query_id", "pk", "score", "rank"]
    nobody = knn.search(held, asked.limit(0), 9, pk="pk", query_id="query_id")
    assert nobody.count() == 0 and nobody.schema == hits.schema


@pytest.mark.parametrize("match", [None, "genre"])
def test_stored_layout_is_searched_by_cell(spark, vectors, tmp_path, match):
    held, asked = frames(spark, vectors, [v for v in vectors if v[2] is not None])
    knn.store_layout(knn.lay_out(held, "pk", match=match, k=8), f"{tmp_path}/layout")
    layout = knn.open_layout(spark, f"{tmp_path}/layout")
    hits = knn.search_layout(layout, asked, 6, "query_id")
    expected = brute_force(vectors, [v for v in vectors if v[2] is not None], 6, match=match is not None)
    same(found(hits), expected)
    few = knn.search_layout(layout, asked.where("query_id = 1"), 6, "query_id")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*shelf#\d+ ", plan), plan  # other folders are not read
    assert few.count() == 6
    with pytest.raises(ValueError, match="made for 8 results"):
        knn.search_layout(layout, asked, 9, "query_id")


def test_layout_of_nothing(spark, tmp_path):
    rows = [(2, [0.0, 0.0], "g"), (4, None, "h")]
    held, asked = frames(spark, rows, [(10, [2.0, 0.0], None)])
    layout = knn.lay_out(held, "pk")
    assert knn.search_layout(layout, asked, 3, "query_id").count() == 0
    with pytest.raises(ValueError, match="no searchable row"):
        knn.store_layout(layout, f"{tmp_path}/layout")


@pytest.mark.parametrize("cell_rows", [None, 40])
def test_approximate_search_recall(spark, vectors, cell_rows):
    held, asked = frames(spark, vectors, vectors)
    exact = knn.search(held, asked, 5, pk="pk", query_id="query_id")
    codes = ann.encode(held, "pk", k=5, cell_rows=cell_rows, sample=200)
    few = ann.search_codes(codes, asked, 5, "query_id")
    assert few.schema == exact.schema
    assert knn.recall(few, exact, "query_id", "pk").first()["recall"] > 0.95
    by_pair = {(r.query_id, r.pk): r.score for r in knn.search(held, asked, 600, pk="pk", query_id="query_id").collect()}
    assert all(by_pair[r.query_id, r.pk] == r.score for r in few.collect())  # scores are exact


def test_approximate_search_of_vectors_without_structure(spark):
    """Nothing can be ruled out by bounds here, and codes alone are not enough to rank by."""
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v], None) for i, v in enumerate(np.float32(draw.normal(size=(2000, 32))))]
    held, asked = frames(spark, rows, rows[:100])
    exact = knn.search(held, asked, 5, pk="pk", query_id="query_id")
    few = ann.search(held, asked, 5, pk="pk", query_id="query_id", cell_rows=150, sample=1000)
    assert knn.recall(few, exact, "query_id", "pk").first()["recall"] >= 0.95


def test_probing_follows_what_is_found(spark, vectors):
    """Clustered rows need few cells, and a higher target never fewer."""
    held, asked = frames(spark, vectors, vectors[1:60])
    codes = ann.encode(held, "pk", k=5, cell_rows=40)
    asks = knn.queries_of(asked, "query_id", "embedding", None)
    cells = codes.cells.select("cell").distinct().count()
    n = [pivots.descend(codes.layout.tree, asks, pivots.likely(5, t, codes.dimensions)).count() for t in (0.5, 0.98)]
    assert n[0] <= n[1] < cells * asks.count()


def test_approximate_search_edges(spark, vectors):
    rows = [(1, [1.0, 0.0], "g"), (2, [0.0, 0.0], "g"), (3, [1.0, 0.0], "h"), (4, None, "h")]
    held, asked = frames(spark, rows, [(10, [2.0, 0.0], "h"), (11, [0.0, 0.0], None), (12, None, None)])
    assert found(ann.search(held, asked, 9, pk="pk", query_id="query_id")) == {10: [(1, 1.0), (3, 1.0)]}
    assert found(ann.search(held, asked, 9, pk="pk", query_id="query_id", match="genre")) == {10: [(3, 1.0)]}
    assert ann.search(held.limit(0), asked, 9, pk="pk", query_id="query_id").count() == 0
    assert ann.search(held, asked.limit(0), 9, pk="pk", query_id="query_id").count() == 0
    named, asked = frames(spark, [v for v in vectors if v[2]], [v for v in vectors if v[2]])
    few = ann.search(named, asked, 4, pk="pk", query_id="query_id", match="genre", cell_rows=30)
    exact = knn.search(named, asked, 4, pk="pk", query_id="query_id", match="genre")
    assert knn.recall(few, exact, "query_id", "pk").first()["recall"] > 0.95


def test_search_plan_has_no_pair_join(spark, vectors):
    held, asked = frames(spark, vectors, vectors)
    hits = knn.search(held, asked, 5, pk="pk", query_id="query_id")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan


ARTICLES = "doc_id string, title string, body string"


@pytest.fixture(scope="module")
def articles(spark):
    return generate.gen_help(spark).select("doc_id", "title", "body")


def test_index_build_sync_and_stats(spark, articles):
    embedder = index.TextEmbedder.fit(articles, "body")
    held = index.build_index(articles, "doc_id", "body", embedder=embedder).cache()
    stats = index.index_stats(held).first()
    assert (stats["n_rows"], stats["n_null_vectors"], stats["min_dims"], stats["ready"]) == (12, 0, 256, True)
    assert index.sync_plan(held, articles, "doc_id").count() == 0  # a second sync changes nothing

    changed = articles.where("doc_id <> 'AJU-001'").withColumn(
        "body", F.when(F.col("doc_id") == "AJU-002", "outro texto").otherwise(F.col("body"))
    ).unionByName(spark.createDataFrame([("AJU-099", "Novo", "texto novo")], ARTICLES))
    plan = {r["doc_id"]: r["change"] for r in index.sync_plan(held, changed, "doc_id").collect()}
    assert plan == {"AJU-001": "delete", "AJU-002": "update", "AJU-099": "insert"}
    level = index.sync_index(held, changed, "doc_id", "body", embedder=embedder)
    fresh = index.build_index(changed, "doc_id", "body", embedder=embedder)
    assert level.count() == 12 and level.exceptAll(fresh.select(*level.columns)).count() == 0


def test_embedder_takes_whole_texts_and_survives_saving(spark, tmp_path):
    text = "palavra " * 30_000
    texts = spark.createDataFrame([(1, text + "fim"), (2, text), (3, ""), (4, None)], "id int, t string")
    embedder = index.TextEmbedder.fit(texts, "t")
    made = {r["id"]: r["embedding"] for r in embedder.embed(texts, "t").collect()}
    assert made[1] != made[2] and not any(made[3]) and not any(made[4])
    embedder.save(f"{tmp_path}/embedder")
    again = index.TextEmbedder.load(f"{tmp_path}/embedder").embed(texts, "t")
    assert {r["id"]: r["embedding"] for r in again.collect()} == made


def test_support_and_titles(spark, articles):
    embedder = index.TextEmbedder.fit(articles, "body")
    held = index.build_index(articles, "doc_id", "body", embedder=embedder)
    asked = embedder.embed(articles.select(F.col("doc_id").alias("query_id"), F.col("body").alias("text")), "text")
    hits = index.support_hits(held, asked, "query_id").where("rank = 1").collect()
    assert len(hits) == 12 and all(r["query_id"] == r["doc_id"] and r["score"] == 1.0 for r in hits)
    context = index.support_context(held, asked, "query_id").where("query_id = 'AJU-003'").first()
    body = articles.where("doc_id = 'AJU-003'").first()["body"]
    assert context["n_hits"] == 3 and context["context"].startswith("Avisos de estreia\n" + body + "\n\n")

    titles = generate.gen_titles(spark, 120)
    words = index.TextEmbedder.fit(titles, "synopsis")
    shelf = index.build_index(titles, "content_id", "synopsis", embedder=words)
    wanted = words.embed(
        titles.limit(20).select(
            F.col("content_id").alias("query_id"), F.col("synopsis").alias("text"), F.col("genre").alias("wanted")
        ), "text",
    )
    rows = index.search_titles(shelf, wanted, "query_id", genre="wanted").join(wanted.select("query_id", "wanted"), "query_id")
    assert rows.where("genre <> wanted").count() == 0 and rows.where("length(synopsis) > 180").count() == 0
    assert rows.where("rank = 1 AND score < 1.0").count() == 0
    assert index.search_titles(shelf, wanted, "query_id").where("rank > 6").count() == 0
    held = [(r[0], r[1], r[2]) for r in shelf.select("content_id", "embedding", "genre").collect()]
    asks = [(r[0], r[1], r[2]) for r in wanted.select("query_id", "embedding", "wanted").collect()]
    got = found(rows.withColumnRenamed("content_id", "pk"))
    same(got, brute_force(held, asks, 6, match=True))


def test_triggered_sync_follows_the_feed(spark, articles, tmp_path):
    embedder = index.TextEmbedder.fit(articles, "body")
    feed, held = f"{tmp_path}/feed", f"{tmp_path}/index"
    later = articles.where("doc_id <> 'AJU-005'").withColumn(
        "title", F.when(F.col("doc_id") == "AJU-006", "Nova").otherwise(F.col("title"))
    )
    states = [articles.limit(0), articles, later]
    for version in (1, 2):
        changes = diff.snapshot_diff(states[version - 1], states[version], "doc_id")
        changes.withColumn("version", F.lit(version)).write.mode("append").parquet(feed)
        arriving = spark.readStream.schema(spark.read.parquet(feed).schema).parquet(feed)
        run = index_sync.start_sync(arriving, held, f"{tmp_path}/progress", "doc_id", "body", embedder)
        run.awaitTermination()
        level = index_sync.read_index(spark, held)
        expected = index.build_index(states[version], "doc_id", "body", embedder=embedder)
        assert level.count() == expected.count()
        assert level.exceptAll(expected.select(*level.columns)).count() == 0
    # nothing new: a further run changes nothing
    index_sync.start_sync(arriving, held, f"{tmp_path}/progress", "doc_id", "body", embedder).awaitTermination()
    assert level.exceptAll(index_sync.read_index(spark, held)).count() == 0
    index_sync.compact(spark, held, f"{tmp_path}/compact")
    assert spark.read.parquet(f"{tmp_path}/compact").exceptAll(level).count() == 0


def test_only_ranges_with_changes_are_merged(spark, articles, tmp_path):
    embedder = index.TextEmbedder.fit(articles, "body")
    held, rows = f"{tmp_path}/index", articles.withColumn("change", F.lit("insert"))
    take = index_sync.take_in(held, "doc_id", "body", embedder)
    take(rows.withColumn("version", F.lit(1)), 0)
    plan = index_sync.read_index(spark, held)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # a folder for each range: nothing to merge
    for batch in (1, 2, 3):
        take(rows.where("doc_id = 'AJU-002'").withColumns({"version": F.lit(batch + 1), "title": F.lit(f"v{batch}")}), batch)
    level = index_sync.read_index(spark, held)
    merged = index_sync._folders(spark, held)
    [hot] = [r for r, (paths, _) in merged.items() if len(paths) > 1]
    plan = level._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert level.where("doc_id = 'AJU-002'").first()["title"] == "v3" and level.count() == 12
    before = {r: paths for r, (paths, _) in merged.items() if r != hot}
    assert index_sync.compact_ranges(spark, held) == [hot]
    after = {r: paths for r, (paths, _) in index_sync._folders(spark, held).items()}
    assert len(after.pop(hot)) == 1 and after == before  # other ranges are where they were
    again = index_sync.read_index(spark, held)
    assert again.exceptAll(level).count() == 0 and again.count() == 12
    gone = rows.where("doc_id = 'AJU-002'").withColumns({"change": F.lit("delete"), "version": F.lit(9)})
    take(gone, 4)
    index_sync.compact_ranges(spark, held, folders=2)
    take(rows.where("doc_id = 'AJU-002'").withColumn("version", F.lit(5)), 5)  # late: the deletion is newer
    assert index_sync.read_index(spark, held).where("doc_id = 'AJU-002'").count() == 0


def test_late_changes_do_not_win(spark, articles, tmp_path):
    embedder = index.TextEmbedder.fit(articles, "body")
    one = articles.where("doc_id in ('AJU-001', 'AJU-002')")
    feed, held = f"{tmp_path}/feed", f"{tmp_path}/index"
    runs = [
        [("AJU-001", "update", 5), ("AJU-002", "insert", 1)], [("AJU-001", "update", 3), ("AJU-002", "delete", 4)],
        [("AJU-002", "insert", 2)],  # older than its deletion
    ]
    for changes in runs:
        told = spark.createDataFrame(changes, "doc_id string, change string, version int")
        rows = one.join(told, "doc_id").withColumn("title", F.concat("title", F.col("version").cast("string")))
        rows.write.mode("append").parquet(feed)
        arriving = spark.readStream.schema(rows.schema).parquet(feed)
        index_sync.start_sync(arriving, held, f"{tmp_path}/progress", "doc_id", "body", embedder).awaitTermination()
    level = index_sync.read_index(spark, held).collect()
    assert [(r.doc_id, r.title[-1]) for r in level] == [("AJU-001", "5")]


def test_moved_columns_are_no_change(spark, articles):
    embedder = index.TextEmbedder.fit(articles, "body")
    held = index.build_index(articles, "doc_id", "body", embedder=embedder)
    assert index.sync_plan(held, articles.select(*reversed(articles.columns)), "doc_id").count() == 0


def test_index_is_created_then_brought_level(spark, articles, tmp_path):
    embedder = index.TextEmbedder.fit(articles, "body")
    for source in (articles, articles.where("doc_id <> 'AJU-003'")):
        level = index.create_or_sync(spark, f"{tmp_path}/i", source, "doc_id", "body", embedder=embedder)
        fresh = index.build_index(source, "doc_id", "body", embedder=embedder)
        assert level.count() == fresh.count() and level.exceptAll(fresh.select(*level.columns)).count() == 0
