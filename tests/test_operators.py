import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subscope.operators import chat, diff, evaluation, features, models, quality, ranking
from subscope.plans import metrics
from subscope.settings import Settings
from subscope.sources import generate, tables

AS_OF = dt.date(2024, 1, 31)
USER = "user_id string, plan string, state string, age_band string, main_device string, signup_date date, status string"
PLAY = "user_id string, content_id string, ts timestamp_ntz, event string, device string, pct_watched double, watch_min int"
TITLE = "content_id string, title string, genre string"


@pytest.fixture(scope="module")
def small(spark):
    def user(key, plan="Free", status="Ativo"):
        return (key, plan, "SP", "18-24", "TV", dt.date(2024, 1, 1), status)

    def play(user, content, event, device, pct, minutes, day):
        return (user, content, dt.datetime(2024, 1, day, 12), event, device, pct, minutes)

    users = [user("a"), user("b", "Premium"), user("c", "Standard", "Cancelado")]
    plays = [
        play("a", "t1", "complete", "TV", 100.0, 90, 10),
        play("a", "t2", "play", "TV", 50.5, 30, 20),
        play("a", "gone", "stop", "Tablet", 10.0, 1, 5),
        play("b", "t3", "complete", "TV", 80.0, 60, 31),
        play("nobody", "t1", "play", "TV", 1.0, 5, 1),
    ]
    titles = [("t1", "X", "Drama"), ("t2", "X", "Drama"), ("t3", "Y", None)]
    return {
        "users": spark.createDataFrame(users, USER),
        "plays": spark.createDataFrame(plays, PLAY),
        "titles": spark.createDataFrame(titles, TITLE),
    }


def test_user_features(small):
    made = features.user_features(small["users"], small["plays"], small["titles"], AS_OF)
    rows = {r["user_id"]: r.asDict() for r in made.collect()}
    assert set(rows) == {"a", "b", "c"}
    a, b, c = rows["a"], rows["b"], rows["c"]
    assert (a["n_events"], a["watch_total"], a["n_genres"], a["n_devices"]) == (3, 121, 1, 2)
    assert a["completion_rate"] == Decimal("0.33333") and a["recency_days"] == 11
    assert a["pct_avg"] == pytest.approx(160.5 / 3) and a["watch_avg"] == pytest.approx(121 / 3)
    assert (b["n_events"], b["n_genres"], b["recency_days"]) == (1, 0, 0)
    assert (c["n_events"], c["watch_avg"], c["completion_rate"], c["recency_days"]) == (0, 0.0, 0, 999)
    assert c["tenure_days"] == 30


def test_user_features_reduce_before_the_user_shuffle(small):
    plan = features.user_features(small["users"], small["plays"], small["titles"], AS_OF)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_partition_filter_reaches_the_scan(spark, small, tmp_path):
    stored = tables.write_table(small["plays"], f"{tmp_path}/plays", partition_by=["event"])
    plan = stored.where(F.col("event") == "complete")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event" in plan
    assert stored.count() == small["plays"].count()


def test_partition_values_keep_their_type(spark, tmp_path):
    rows = spark.createDataFrame([(1, "007"), (2, "08")], "n int, code string")
    stored = tables.write_table(rows, f"{tmp_path}/codes", partition_by=["code"])
    assert sorted(map(tuple, stored.select("n", "code").collect())) == [(1, "007"), (2, "08")]
    empty = tables.write_table(rows.limit(0), f"{tmp_path}/none", partition_by=["code"])
    assert empty.count() == 0 and set(empty.columns) == {"n", "code"}


def test_tables_by_name(spark, small):
    place = Settings(database="subscope_test")
    tables.ensure_schema(spark, place.database)
    name = place.table("users")
    assert tables.write_table(small["users"], name).count() == 3
    fewer = small["users"].select("user_id", F.lit(1).alias("extra"))
    assert tables.write_table(fewer, name).columns == ["user_id", "extra"]  # the schema is replaced
    assert tables.write_report(tables.read_table(spark, name), "users").first() == ("users", 3)
    assert tables.preview(fewer, 2, ["user_id"]).count() == 2
    assert tables.drop_dataset(spark, place.database, ["users"]) == [f"DROP TABLE IF EXISTS {name}"]
    assert spark.catalog.tableExists(name)
    tables.drop_dataset(spark, place.database, ["users"], confirm=True)
    assert not spark.catalog.tableExists(name)
    tables.drop_dataset(spark, place.database, confirm=True)
    assert not spark.catalog.databaseExists(place.database)


def test_checks(spark):
    child = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, "y")], "k int, v string")
    parent = spark.createDataFrame([(2,)], "k int")
    assert sorted(map(tuple, quality.check_not_null(child, ["k", "v"]).collect())) == [("k", 1), ("v", 1)]
    assert [tuple(r) for r in quality.check_unique(child, ["k"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.check_foreign_key(child, parent, "k").collect()] == [(1, 2)]
    assert quality.check_not_null(parent, ["k"]).count() == 0


SNAP = "id int, a string, b string"


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "x", None), (2, "x", "y"), (3, "p", "q"), (4, "m", None)], SNAP)
    new = spark.createDataFrame([(1, "x", None), (2, "x", "z"), (4, None, "m"), (5, None, None)], SNAP)
    changes = diff.snapshot_diff(old, new, "id")
    kinds = {r["id"]: r["change"] for r in changes.collect()}
    assert kinds == {2: "update", 3: "delete", 4: "update", 5: "insert"}
    assert diff.snapshot_diff(old, old, "id").count() == 0
    after = diff.apply_diff(old, changes, "id")
    assert sorted(map(str, after.collect())) == sorted(map(str, new.collect()))
    assert {tuple(r) for r in diff.count_changes(changes).collect()} == {("update", 2), ("delete", 1), ("insert", 1)}


def test_snapshot_diff_refuses_duplicate_keys(spark):
    twice = spark.createDataFrame([(1, "x", None), (1, "y", None)], SNAP)
    with pytest.raises(Exception, match="duplicate key in id: 1"):
        diff.snapshot_diff(twice, twice.limit(1), "id").collect()


def test_top_k_breaks_ties_by_key(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("d", 1)], "k string, n int")
    assert [r["k"] for r in ranking.top_k(rows, "n", 3, "k").collect()] == ["c", "a", "b"]


def test_envelope_holds_fifty_rows(spark):
    row = ranking.result_envelope(spark.range(200).select(F.col("id").alias("n"))).first()[0]
    assert row.startswith('{"colunas":["n"],"linhas":[["0"],["1"],') and row.count("[") == 1 + 1 + 50
    last = ranking.result_envelope(spark.range(200), [F.desc("id")], limit=2).first()[0]
    assert last == '{"colunas":["id"],"linhas":[["199"],["198"]]}'
    empty = ranking.result_envelope(spark.range(0)).first()[0]
    assert empty == '{"colunas":["id"],"linhas":[]}'


def auc_of(spark, rows):
    return evaluation.roc_auc(spark.createDataFrame(rows, "score double, label int")).first()["auc"]


def test_auc(spark):
    assert auc_of(spark, [(0.5, 1), (0.5, 0), (0.5, 0)]) == 0.5
    assert auc_of(spark, [(0.9, 1), (0.8, 1), (0.1, 0)]) == 1.0
    assert auc_of(spark, [(0.1, 1), (0.9, 0)]) == 0.0
    assert auc_of(spark, [(0.1, 1), (0.9, 1)]) is None
    assert auc_of(spark, []) is None


def test_auc_over_many_ranges_is_exact(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.pmod(F.xxhash64("id"), F.lit(9973)) / 9973).alias("score"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).cast("int").alias("label"),
    )
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(rows)
    assert evaluation.roc_auc(rows).first()["auc"] == pytest.approx(exact, abs=1e-12)


def test_report(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.2, 1), (0.5, 0), (0.1, 0)], "score double, label int")
    report = {r["entry"]: r.asDict() for r in evaluation.classification_report(rows).collect()}
    assert report["1"] == {"entry": "1", "precision": 0.5, "recall": 0.5, "f1": 0.5, "support": 2}
    assert report["accuracy"]["f1"] == 0.5 and report["accuracy"]["precision"] is None
    never = spark.createDataFrame([(0.1, 1), (0.1, 0), (0.1, 0)], "score double, label int")
    report = {r["entry"]: r.asDict() for r in evaluation.classification_report(never).collect()}
    assert (report["1"]["precision"], report["1"]["recall"], report["1"]["f1"]) == (0.0, 0.0, 0.0)
    assert report["0"]["precision"] == pytest.approx(2 / 3)
    assert report["weighted avg"]["precision"] == pytest.approx(2 / 3 * 2 / 3)
    wrong = spark.createDataFrame([(0.9, 0), (0.1, 1)], "score double, label int")
    report = {r["entry"]: r.asDict() for r in evaluation.classification_report(wrong).collect()}
    assert report["macro avg"]["f1"] == 0.0 and report["accuracy"]["f1"] == 0.0
    one = spark.createDataFrame([(0.9, 1)], "score double, label int")
    assert {r["entry"] for r in evaluation.classification_report(one).collect()} == {
        "1", "accuracy", "macro avg", "weighted avg"
    }


def test_split_shares_are_exact(spark):
    rows = spark.range(10_001).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    parted = models.split(rows, "id")
    counts = {(r["label"], r["split"]): r["n_rows"] for r in models.split_shares(parted).collect()}
    assert counts == {(1, "test"): 250, (1, "train"): 751, (0, "test"): 2250, (0, "train"): 6750}
    again = models.split(rows.repartition(7), "id")
    assert parted.exceptAll(again).count() == 0
    tiny = spark.createDataFrame([(1, 1), (2, 0)], "id int, label int")
    assert {r["split"] for r in models.split(tiny, "id").collect()} == {"train"}


def test_metric_layer(small):
    held = {**small, "user_features": features.user_features(small["users"], small["plays"], small["titles"], AS_OF)}
    by_plan = {r["plan"]: r["avg_watch_minutes"] for r in metrics.watch_by_plan(held).collect()}
    assert by_plan == {"Free": pytest.approx(121 / 3), "Premium": 60.0}
    top = [tuple(r) for r in metrics.top_titles_views(held).collect()]
    assert top == [("X", "Drama", 3), ("Y", None, 1)]
    assert metrics.metric(held, "play_count").first()[0] == 5
    assert metrics.metric(held, "play_count", where={"genre": "Drama", "plan": "Free"}).first()[0] == 2
    assert metrics.metric(held, "payer_count", ["state"]).first()["payer_count"] == 2
    assert metrics.metric(held, "watch_minutes", ["device", "plan"], limit=1).collect()[0]["watch_minutes"] == 120
    with pytest.raises(ValueError, match="no table joined to titles"):
        metrics.metric(held, "title_count", ["plan"])
    with pytest.raises(ValueError, match="unknown measure"):
        metrics.metric(held, "nothing")


def test_chat(spark):
    items = spark.createDataFrame(
        [
            (1, 0, "developer", '"rules"'), (1, 1, "user", '[{"type":"input_text","text":"hi"}]'),
            (1, 2, "tool", '"x"'), (1, 3, "assistant", '"yes"'), (2, 0, "reasoning", "null"), (2, 1, None, "null"),
        ],
        "conv_id int, turn int, role string, content string",
    )
    rows = [tuple(r) for r in chat.chat_messages(items, "S").orderBy("conv_id", "turn").collect()]
    assert rows == [
        (1, -1, "system", "S"), (1, 0, "system", "rules"), (1, 1, "user", "hi"), (1, 3, "assistant", "yes"),
        (2, -1, "system", "S"),
    ]


@pytest.fixture(scope="module")
def generated(spark):
    latent = generate.gen_users_latent(spark, AS_OF, 3000, 25_000)
    users, titles = generate.gen_users(latent), generate.gen_titles(spark, 300)
    made = features.user_features(users, generate.gen_plays(latent, AS_OF, 300), titles, AS_OF).cache()
    return {"users": users, "user_features": made}


def test_engagement_differs_by_status(generated):
    rows = {r["status"]: r for r in metrics.features_by_status(generated).collect()}
    for column in ("avg_events", "avg_watch_total", "avg_completion"):
        assert rows["Ativo"][column] > rows["Cancelado"][column]
    churn = {r["plan"]: r["churn_pct"] for r in metrics.churn_by_plan(generated).collect()}
    assert churn["Free"] > churn["Standard"] > churn["Premium"]


@pytest.mark.parametrize("spec", [models.CHURN, models.UPGRADE], ids=lambda s: s.name)
def test_model_learns_and_scores(spark, generated, spec, tmp_path):
    rows = models.split(models.targets(generated["user_features"], spec), "user_id").cache()
    model = models.fit(rows.where("split = 'train'"), spec, rounds=5)
    auc, report = models.evaluate(model, rows.where("split = 'test'"))
    assert auc.first()["auc"] > (0.6 if spec is models.CHURN else 0.85)
    assert report.count() == 5
    scores = models.score(model, rows, spec)
    wanted = rows if spec.only_plan is None else rows.where(F.col("plan") == "Free")
    assert scores.count() == wanted.count()
    assert scores.columns == [*spec.keep, "split", spec.score_col, spec.band_col]
    means = [r["avg_score"] for r in models.band_summary(scores, spec.score_col, spec.band_col).collect()]
    assert means == sorted(means, reverse=True)
    assert models.importances(model, spec).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    models.save(model, f"{tmp_path}/model")
    again = models.score(models.load(f"{tmp_path}/model"), rows, spec)
    assert scores.exceptAll(again).count() == 0


def test_unknown_level_encodes_as_zeros(spark, generated):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = models.targets(generated["user_features"], models.CHURN)
    encoder = Pipeline(stages=models.feature_stages(models.CHURN)).fit(rows)
    strange = rows.limit(1).withColumns({"state": F.lit("XX"), "plan": F.lit(None).cast("string")})
    values = encoder.transform(strange).select(vector_to_array("features")).first()[0]
    assert sum(values[: -len(models.NUMERIC)]) == 2  # age band and device only


def test_null_keys_are_refused(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    with pytest.raises(Exception, match="null key in k"):
        diff.snapshot_diff(old, new, "k").collect()


def test_counts_over_nothing_are_zero(small):
    for name in ("play_count", "user_count"):
        assert metrics.metric(small, name, where={"plan": "Gold"}).first()[name] == 0
    for name in ("watch_minutes", "completion_rate"):
        assert metrics.metric(small, name, where={"plan": "Gold"}).first()[name] is None


def test_only_changed_rows_are_moved(spark):
    old = spark.range(0, 30_000).selectExpr("id", "id % 7 as v")
    new = spark.range(10, 30_010).selectExpr("id", "if(id % 1000 = 0, -1, id % 7) as v")
    told = diff.snapshot_diff(old, new, "id")
    assert diff.apply_diff(old, told, "id").exceptAll(new).count() == 0
    assert {r["change"]: r["count"] for r in told.groupBy("change").count().collect()} == {
        "insert": 10, "delete": 10, "update": 29,
    }
    payload = told._jdf.queryExecution().executedPlan().toString()
    assert "maybe" in payload or "_bits" in payload
