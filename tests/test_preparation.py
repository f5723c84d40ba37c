from subscope import schemas
from subscope.operators import index, models
from subscope.plans import metrics
from subscope.plans.preparation import TABLES, build_features, build_indexes, prepare, train_and_score
from subscope.settings import Settings
from subscope.sources import tables

DECLARED = {
    "titles": schemas.TITLES, "users": schemas.USERS, "plays": schemas.PLAYS,
    "help_articles": schemas.HELP_ARTICLES, "user_features": schemas.USER_FEATURES,
    "churn_scores": schemas.CHURN_SCORES, "upgrade_scores": schemas.UPGRADE_SCORES,
}


def test_prepare_from_nothing_to_answers(spark, tmp_path):
    place = Settings(database="subscope_prepared")
    held = prepare(spark, place, n_users=800, n_titles=60, n_plays=6000, rounds=3, embedders_path=f"{tmp_path}/embedders")
    assert set(held) == set(TABLES)
    for name, schema in DECLARED.items():
        schemas.require(held[name], schema)
    counts = {name: df.count() for name, df in held.items()}
    assert counts["users"] == counts["user_features"] == counts["churn_scores"] == 800
    assert counts["titles"] == counts["titles_index"] == 60 and counts["help_index"] == 12
    assert counts["upgrade_scores"] == held["users"].where("plan = 'Free'").count()
    assert 5000 < counts["plays"] < 7000

    assert metrics.free_high_band(held).first()[0] <= counts["upgrade_scores"]
    assert metrics.metric(held, "completion_rate", ["genre"]).count() <= 18
    assert metrics.metric(held, "high_risk_users", ["plan"]).count() <= 3
    assert metrics.user_profile(held, held["users"].limit(5)).count() == 5
    assert index.index_stats(held["titles_index"]).first()["ready"]

    embedder = index.TextEmbedder.load(f"{tmp_path}/embedders/help")
    asked = embedder.embed(spark.createDataFrame([(1, "posso baixar títulos?")], "query_id int, text string"), "text")
    assert index.support_context(held["help_index"], asked, "query_id").first()["n_hits"] == 3

    before = held["help_index"].collect()
    fewer = spark.createDataFrame([r for r in held["help_articles"].collect() if r["doc_id"] != "AJU-004"], held["help_articles"].schema)
    tables.write_table(fewer, place.table("help_articles"))
    build_indexes(spark, place, f"{tmp_path}/embedders")  # brought level, by the embedder that was kept
    after = tables.read_table(spark, place.table("help_index")).collect()
    assert sorted(map(str, after)) == sorted(str(r) for r in before if r["doc_id"] != "AJU-004")

    build_features(spark, place)  # a step can be run again
    scores, auc, report = train_and_score(spark, place, models.CHURN, 2, f"{tmp_path}/churn")
    assert scores.count() == 800 and auc.count() == 1 and report.count() == 5
    assert models.load(f"{tmp_path}/churn").stages
    tables.drop_dataset(spark, place.database, confirm=True)
    assert not spark.catalog.databaseExists(place.database)
