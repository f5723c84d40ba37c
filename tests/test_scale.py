"""Hot keys: one user, one title, one score and one vector that hold a third of the rows each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subscope.operators import ann, diff, evaluation, features, index, knn, models, quality, skew
from subscope.plans import metrics
from subscope.sources import generate, tables

AS_OF = dt.date(2024, 1, 31)
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    latent = generate.gen_users_latent(spark, AS_OF, 2000, 60_000)
    draw = F.xxhash64("event_id")
    plays = generate.gen_plays(latent, AS_OF, 400).withColumns({
        "user_id": F.when(F.pmod(draw, F.lit(3)) == 0, "U0000001").otherwise(F.col("user_id")),
        "content_id": F.when(F.pmod(F.shiftright(draw, 8), F.lit(3)) == 0, "NBP000001").otherwise(F.col("content_id")),
    })
    made = {"plays": plays, "users": generate.gen_users(latent), "titles": generate.gen_titles(spark, 400)}
    return {name: tables.write_table(df, f"{folder}/{name}") for name, df in made.items()}


@pytest.fixture
def no_broadcast(spark):
    for key, value in NO_BROADCAST.items():
        spark.conf.set(key, value)
    yield
    for key in NO_BROADCAST:
        spark.conf.unset(key)


def rows_and_plan(df):
    rows = sorted(map(str, df.collect()))
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_title_is_split_in_the_feature_join(spark, hot, no_broadcast, adaptive):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", adaptive)
    rows, plan = rows_and_plan(features.user_features(hot["users"], hot["plays"], hot["titles"], AS_OF))
    assert "BroadcastHashJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    again, plan = rows_and_plan(features.user_features(hot["users"], hot["plays"], hot["titles"], AS_OF))
    assert "BroadcastHashJoin" in plan and rows == again
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_heavy_keys_are_dealt_to_many_tasks(spark, hot, no_broadcast, adaptive):
    """However adaptive execution is set, no task of the join has more than a small part of the rows."""
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    plays, titles = hot["plays"].select("event_id", "content_id"), hot["titles"].select("content_id", "genre")
    heavy = skew.heavy_keys(plays, "content_id")
    n = plays.count()
    counts = {r["content_id"]: r["count"] for r in plays.groupBy("content_id").count().collect()}
    assert set(heavy) >= {k for k, c in counts.items() if c >= 1.2 * n / 1000} and heavy["NBP000001"] > 0.3
    assert all(abs(heavy[k] - counts[k] / n) < 0.0002 for k in heavy)
    joined = skew.spread_join(plays, titles, "content_id", "event_id", heavy)
    largest = max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    plain = plays.join(titles, "content_id", "left")
    assert largest < 0.12 * n
    assert joined.exceptAll(plain.select(*joined.columns)).count() == 0 and joined.count() == n
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_joins_of_few_and_odd_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d"), (9, "e")], "k long, salt string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "k long, v string")
    heavy = skew.heavy_keys(left, "k", share=0.2)
    assert set(heavy) == {1, 2, 9}
    for how in ("inner", "left", "left_semi", "left_anti"):
        found = skew.spread_join(left, right, "k", "salt", heavy, how, 5)
        want = left.join(right, "k", how)
        assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError):
        skew.spread_join(left, right, "k", "salt", heavy, "full")
    assert skew.heavy_keys(left.limit(0), "k") == {}


def test_hot_keys_are_split_in_the_star_join(hot, no_broadcast):
    joined = metrics.star(hot, "plays", ["users", "titles"])
    rows, plan = rows_and_plan(joined)
    assert "skew=true" in plan and len(rows) == hot["plays"].count()


def test_measures_reduce_before_they_join(hot, no_broadcast):
    rows, plan = rows_and_plan(metrics.watch_by_plan(hot))
    join = plan.index("SortMergeJoin")
    assert "partial_sum(watch_min" in plan[join:] and "skew=true" not in plan
    assert len(rows) == 3


def test_features_do_not_depend_on_the_partitioning(spark, hot):
    one = features.user_features(hot["users"], hot["plays"].repartition(1), hot["titles"], AS_OF)
    many = features.user_features(hot["users"], hot["plays"].repartition(23), hot["titles"], AS_OF)
    assert one.exceptAll(many).count() == 0 and one.count() == many.count() == 2000
    known = one.agg(F.sum("n_events")).first()[0]
    assert known == hot["plays"].count()


def test_hot_score_and_hot_label(hot):
    scored = hot["plays"].select(
        F.when(F.col("user_id") == "U0000001", 0.5).otherwise(F.pmod(F.xxhash64("event_id"), F.lit(997)) / 997).alias("score"),
        (F.col("event") == "complete").cast("int").alias("label"), "event_id",
    )
    row = evaluation.roc_auc(scored).first()
    assert row["n_positive"] + row["n_negative"] == scored.count() and 0.4 < row["auc"] < 0.6
    parted = models.split(scored, "event_id")
    for r in models.split_shares(parted).groupBy("label").pivot("split").sum("n_rows").collect():
        assert r["test"] == int((r["test"] + r["train"]) * 0.25 + 0.5)


def test_hot_keys_in_checks(hot):
    assert quality.check_unique(hot["plays"], ["user_id"]).where("user_id = 'U0000001'").first()["n_rows"] > 15_000
    orphans = quality.check_foreign_key(hot["plays"], hot["users"].where("user_id <> 'U0000001'"), "user_id")
    assert [r["user_id"] for r in orphans.collect()] == ["U0000001"]
    assert diff.snapshot_diff(hot["users"], hot["users"], "user_id").count() == 0


def test_hot_partition_value_is_written_by_many_tasks(spark, hot, tmp_path, no_broadcast):
    stored = tables.write_table(
        hot["plays"].withColumn("event", F.lit("play")), f"{tmp_path}/plays", partition_by=["event"]
    )
    assert len(stored.inputFiles()) > 1 and stored.count() == hot["plays"].count()


def test_hot_vector_meets_bounded_blocks(spark, monkeypatch):
    """A third of 3,000 rows are copies of one vector, and a third of the queries ask for it."""
    sizes = spark.sparkContext.accumulator(0)
    copies = F.array(*[F.lit(1.0)] + [F.lit(0.0)] * 7)
    other = F.transform(
        F.sequence(F.lit(1), F.lit(8)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(2001)) / 1000.0 - 1.0
    )
    rows = spark.range(3000).select(
        F.col("id").alias("pk"),
        F.when(F.col("id") % 3 == 0, copies).otherwise(other).cast("array<float>").alias("embedding"),
    )
    plain = knn.scorer

    def watched(k):
        score = plain(k)

        def run(asks, found):
            if asks.num_rows > 2 * 64 or found.num_rows > 2 * 64:
                sizes.add(1)
            return score(asks, found)

        return run

    monkeypatch.setattr(knn, "scorer", watched)
    hits = knn.search(
        rows, rows.withColumnRenamed("pk", "query_id"), 4, pk="pk", query_id="query_id", block_rows=64, query_rows=64
    )
    found = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "pk"))).alias("hits")).collect()
    assert sizes.value == 0
    assert len(found) == 3000
    for r in found:
        keys = [h["pk"] for h in r["hits"]]
        if r["query_id"] % 3 == 0:
            assert keys == [0, 3, 6, 9]  # of a thousand equal rows, the smallest keys
        else:
            assert keys[0] == r["query_id"]


def test_sync_embeds_only_what_changed(spark):
    embedded = []

    class Counting(index.TextEmbedder):
        def embed(self, df, text_col, output="embedding"):
            embedded.append(df)
            return super().embed(df, text_col, output)

    texts = spark.range(50).select("id", F.concat(F.lit("texto "), F.col("id").cast("string")).alias("t"))
    fitted = Counting(index.TextEmbedder.fit(texts, "t")._model)
    held = index.build_index(texts, "id", "t", embedder=fitted).cache()
    later = texts.where("id <> 7").withColumn("t", F.when(F.col("id") == 8, "novo").otherwise(F.col("t")))
    index.sync_index(held, later, "id", "t", embedder=fitted).collect()
    assert embedded[0].count() == 50 and embedded[1].count() == 1


@pytest.mark.parametrize("kind", ["exact", "coded"])
def test_a_query_travels_once_to_a_pack(spark, monkeypatch, kind):
    """400 rows in many small cells, none of which can be left out, are one pack."""
    asked = spark.sparkContext.accumulator(0)
    vector = F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: F.pmod(F.xxhash64("pk", i), F.lit(2001)) / 1000.0 - 1.0)
    rows = spark.range(400).withColumnRenamed("id", "pk").withColumn("embedding", vector.cast("array<float>"))
    where, name = (knn, "scorer") if kind == "exact" else (ann, "_decoder")
    plain = getattr(where, name)

    def watched(*args):
        score = plain(*args)

        def run(asks, found):
            asked.add(asks.num_rows)
            return score(asks, found)

        return run

    monkeypatch.setattr(where, name, watched)
    queries = rows.where("pk < 50").withColumnRenamed("pk", "query_id")
    if kind == "exact":
        layout = knn.lay_out(rows, "pk", k=4, block_rows=512, cell_rows=16)
        assert layout.tree.cells.select("cell").distinct().count() > 20
        hits = knn.search_layout(layout, queries, 4, "query_id")
    else:
        hits = ann.search_codes(ann.encode(rows, "pk", k=4, cell_rows=16, sample=200), queries, 4, "query_id")
    assert hits.where("rank = 1 AND query_id = pk").count() == 50
    assert asked.value == 50


def test_training_runs_in_whole_rounds_of_all_cores():
    assert [models.partitions(n, 12) for n in (0, 11_000, 500_000, 675_000, 4_050_000)] == [1, 1, 10, 12, 72]
