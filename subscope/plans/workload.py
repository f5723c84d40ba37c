"""The registered queries: every operator over the warehouse tables, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions.content import flatten_content
from subscope.functions.draws import hash_uniform, padded_key, pick
from subscope.functions.scoring import band, round_score
from subscope.operators import ann, chat, diff, evaluation, features, index, knn, models, quality, ranking, text_index, trees
from subscope.plans import metrics
from subscope.settings import ACTIVE, BAND_EDGES, RISK_BANDS, Settings, cut, shared_folder
from subscope.sources import banks, generate, proxy, tables
from subscope.streaming import index_sync

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = Settings().as_of
PORTABLE = "md5"
PLAYS_PER_USER = generate.N_PLAYS / generate.N_USERS
SYSTEM_TEXT = "Responda em português do Brasil, apenas com o que as ferramentas trouxerem."
GRADED_CHARS = 500
FEED_DAY = "2024-01-16"  # some plays come before it, some after


class Warehouse(Mapping[str, DataFrame]):
    """The tables by name; a plan is built for those that are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._at = (spark, sf_dir)
        self._views: dict[str, Callable[[], DataFrame]] = {
            "users": lambda: proxy.users(*self._at),
            "titles": lambda: proxy.titles(*self._at),
            "plays": lambda: proxy.plays(*self._at),
            "user_features": lambda: features.user_features(
                self["users"], self["plays"], self["titles"], AS_OF
            ),
            "churn_scores": lambda: proxy.churn_scores(self["users"]),
            "upgrade_scores": lambda: proxy.upgrade_scores(self["users"]),
        }
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._views[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._views)

    def __len__(self) -> int:
        return len(self._views)


def _table(name: str) -> Query:
    return lambda spark, sf_dir: Warehouse(spark, sf_dir)[name]


def _question(ask: Callable[[metrics.Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: ask(Warehouse(spark, sf_dir))


def _run_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- scans, sinks, checks ---


def scan_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.users(spark, sf_dir).select("user_id", "plan", "state", "signup_date", "status")


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = tables.write_table(scan_users(spark, sf_dir), _run_folder(spark, "users"))
    return stored.select("user_id", "plan", "state", "signup_date", "status")


def partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _run_folder(spark, "plays")
    stored = tables.write_table(proxy.plays(spark, sf_dir), target, partition_by=["event"])
    done = stored.where(F.col("event") == "complete")
    return done.groupBy("device").agg(F.count("*").alias("total"), F.sum("watch_min").alias("minutes"))


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables are written and what was stored is counted."""
    held, folder = Warehouse(spark, sf_dir), _run_folder(spark, "counted")
    reports = [
        tables.write_report(tables.write_table(held[t], f"{folder}/{t}"), t)
        for t in ("users", "titles", "plays", "churn_scores")
    ]
    return reduce(DataFrame.unionByName, reports)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, where they have any."""
    labels = proxy.source(spark, sf_dir, "labels")
    labelled = proxy.source(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return quality.check_not_null(labelled, ["doc_id", "text", "lang", "quality", "toxic"])


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(proxy.titles(spark, sf_dir), ["title", "genre"])


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = Warehouse(spark, sf_dir)
    labels = proxy.source(spark, sf_dir, "labels")
    documents = proxy.source(spark, sf_dir, "documents")
    checks = {
        "plays.user_id": quality.check_foreign_key(held["plays"], held["users"], "user_id"),
        "plays.content_id": quality.check_foreign_key(held["plays"], held["titles"], "content_id"),
        "documents.doc_id": quality.check_foreign_key(documents, labels, "doc_id"),
    }
    found = [
        orphans.select(
            F.lit(reference).alias("reference"),
            F.col(orphans.columns[0]).cast("string").alias("key"),
            "n_rows",
        )
        for reference, orphans in checks.items()
    ]
    return reduce(DataFrame.unionByName, found)


def dq_unique_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checked table of films, to which series are added: only what is added is checked."""
    titles, folder = proxy.titles(spark, sf_dir), _run_folder(spark, "checked")
    held = tables.write_table(titles.where("kind = 'Filme'"), f"{folder}/titles")
    state = quality.checked_unique(held, ["title", "genre"])
    state = quality.CheckedKeys(
        tables.write_table(state.bits, f"{folder}/bits"), tables.write_table(state.violations, f"{folder}/violations")
    )
    return quality.check_unique_feed(held, state, titles.where("kind <> 'Filme'"), ["title", "genre"])


def dq_orphans_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays whose references have been checked up to a day, and the plays since."""
    held = Warehouse(spark, sf_dir)
    earlier, later = _feeds(held["plays"])
    state = quality.checked_reference(earlier, held["titles"], "content_id")
    return quality.check_foreign_key_feed(state, held["titles"], later, "content_id")


def _feeds(plays: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The plays before a day and since."""
    return plays.where(F.col("ts") < FEED_DAY), plays.where(F.col("ts") >= FEED_DAY)


def user_features_fed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features kept as state: the plays up to a day are taken in and stored, then those since."""
    held, folder = Warehouse(spark, sf_dir), _run_folder(spark, "state")
    earlier, later = (features.engagement_state(feed, held["titles"]) for feed in _feeds(held["plays"]))
    kept = tables.write_table(earlier, f"{folder}/earlier")
    level = tables.write_table(features.merge_states(kept, later), f"{folder}/later")
    return features.features_of(held["users"], level, AS_OF)


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by one with other columns."""
    held, target = Warehouse(spark, sf_dir), f"{_run_folder(spark, 'replaced')}/t"
    tables.write_table(held["users"], target)
    return tables.write_table(held["churn_scores"], target)


def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = proxy.titles(spark, sf_dir).select("content_id", "title", "genre", "kind")
    return tables.preview(shown, 10, ["genre", "title", "content_id"])


def result_envelope_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows than an envelope takes."""
    counts = Warehouse(spark, sf_dir)["users"].groupBy("state", "plan").agg(F.count("*").alias("n"))
    return ranking.result_envelope(counts, [F.desc("n"), "state", "plan"])


TURN = "1997-06-01"  # some customers order on both sides of it, some on one


def _customers_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What is known of customers from the orders before a day, and from the orders since."""
    day = F.col("o_orderdate").cast("date")
    orders = proxy.source(spark, sf_dir, "orders").withColumn("day", day)
    sides = (orders.where(F.col("day") < TURN), orders.where(F.col("day") >= TURN))
    user_id = padded_key(banks.USER_KEY, "o_custkey").alias("user_id")
    return tuple(
        side.groupBy(user_id).agg(F.count("*").alias("n_orders"), F.max(F.dayofweek("day")).alias("last_weekday"))
        for side in sides
    )


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _customers_of(spark, sf_dir)
    return diff.snapshot_diff(before, after, "user_id")


def snapshot_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _customers_of(spark, sf_dir)
    return diff.apply_diff(before, diff.snapshot_diff(before, after, "user_id"), "user_id")


def result_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.users_by_plan(Warehouse(spark, sf_dir))
    return ranking.result_envelope(counts, [F.desc("user_count"), "plan"])


# --- generated tables ---


def _keys(spark: SparkSession, sf_dir: str, table: str, key: str) -> DataFrame:
    return tables.spread_scan(proxy.source(spark, sf_dir, table).select(F.col(key).alias("n")), "n")


def gen_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _keys(spark, sf_dir, "events", "event_id")
    return keys.select(
        "n",
        pick(banks.OTHER_EVENTS, "evt", "n", PORTABLE).alias("event"),
        pick(banks.DEVICES, "dispe", "n", PORTABLE).alias("device"),
        hash_uniform("n", "u", PORTABLE).alias("u"),
    )


def gen_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.titles_for(_keys(spark, sf_dir, "part", "p_partkey"), PORTABLE)


def _latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _keys(spark, sf_dir, "customer", "c_custkey")
    return generate.users_for(keys, PLAYS_PER_USER, AS_OF, PORTABLE)


def gen_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_users(_latent(spark, sf_dir))


def gen_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_titles = proxy.source(spark, sf_dir, "part").count()
    return generate.plays_of(_latent(spark, sf_dir), n_titles, AS_OF, PORTABLE)


# --- joins, measures ---


def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = metrics.star(Warehouse(spark, sf_dir), "plays", ["users", "titles"])
    return joined.select("event_id", "user_id", "plan", "state", "content_id", "genre", "watch_min")


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = Warehouse(spark, sf_dir)
    return metrics.user_profile(held, held["plays"].select("user_id"))


def metric_churn_by_state(held: metrics.Tables) -> DataFrame:
    return metrics.metric(held, "churn_rate", ["state"])


def metric_completion_by_genre(held: metrics.Tables) -> DataFrame:
    return metrics.metric(held, "completion_rate", ["genre"])


def metric_minutes_by_plan_device(held: metrics.Tables) -> DataFrame:
    """Active payers only: a condition on a dimension, grouped by fact and dimension together."""
    where = {"status": ACTIVE, "plan": ["Standard", "Premium"]}
    return metrics.metric(held, "watch_minutes", ["plan", "device"], where)


def metric_payers_by_age(held: metrics.Tables) -> DataFrame:
    return metrics.metric(held, "payer_count", ["age_band"])


def metric_premium_users(held: metrics.Tables) -> DataFrame:
    return metrics.metric(held, "user_count", where={"plan": "Premium"})


def metric_high_risk_by_state(held: metrics.Tables) -> DataFrame:
    return metrics.metric(held, "high_risk_users", ["state"])


# --- scores ---


def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p")
    scored = proxy.scored(proxy.users(spark, sf_dir))
    return scored.select(
        "user_id", round_score(p).alias("prob_churn"), band(p, RISK_BANDS).alias("risk_band")
    )


def band_distribution(held: metrics.Tables) -> DataFrame:
    churn = models.band_summary(held["churn_scores"], "prob_churn", "risk_band")
    upgrade = models.band_summary(held["upgrade_scores"], "prob_upgrade", "band")
    return churn.withColumn("model", F.lit("churn")).unionByName(
        upgrade.withColumn("model", F.lit("upgrade"))
    )


def retention_targets(held: metrics.Tables) -> DataFrame:
    return models.best_targets(held["churn_scores"], "prob_churn", status=ACTIVE, extra=["plan"])


def upgrade_targets(held: metrics.Tables) -> DataFrame:
    return models.best_targets(held["upgrade_scores"], "prob_upgrade")


def _labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.scored(proxy.users(spark, sf_dir)).select(
        F.col("p").alias("score"), models.churn_target().alias("label")
    )


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.roc_auc(_labelled_scores(spark, sf_dir))


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.classification_report(_labelled_scores(spark, sf_dir))


def label_base_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.label_base_rate(_labelled_scores(spark, sf_dir))


def _target(make: Callable[[], Column]) -> Query:
    return lambda spark, sf_dir: proxy.users(spark, sf_dir).select("user_id", make().alias("label"))


# --- models ---


def split_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = proxy.users(spark, sf_dir).select("user_id", models.churn_target().alias("label"))
    return models.split_shares(models.split(rows, "user_id", mode=PORTABLE))


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = proxy.users(spark, sf_dir).select("user_id", models.churn_target().alias("label"))
    return models.split(rows, "user_id", mode=PORTABLE)


_MODELS: dict[tuple, str] = {}  # where this session has stored each model


def _trained(spark: SparkSession, sf_dir: str, spec: models.ModelSpec):
    """The stored model, loaded, and the stored rows it was made from; trained when first asked for.

    A model is known by the files that its features come from, with their times and sizes: it is trained anew for other data.
    """
    read = Warehouse(spark, sf_dir)["user_features"]
    made = (spark.sparkContext.applicationId, spec.name, *tables.file_versions(read))
    if made not in _MODELS:
        folder = _run_folder(spark, spec.name)
        rows = models.split(models.targets(read, spec), "user_id")
        rows = tables.write_table(rows, f"{folder}/rows")
        models.save(models.fit(rows.where(F.col("split") == "train"), spec), f"{folder}/model")
        _MODELS[made] = folder
    return models.load(f"{_MODELS[made]}/model"), tables.read_table(spark, f"{_MODELS[made]}/rows")


def onehot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many columns the encoded features have, and how many levels are set, per user."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = models.targets(Warehouse(spark, sf_dir)["user_features"], models.CHURN)
    encoded = Pipeline(stages=models.feature_stages(models.CHURN)).fit(rows).transform(rows)
    values = vector_to_array("features")
    levels = F.slice(values, F.lit(1), F.size(values) - len(models.CHURN.numeric))
    return encoded.select(
        "user_id",
        F.size(values).alias("n_columns"),
        F.aggregate(levels, F.lit(0.0), lambda a, x: a + x).cast("int").alias("n_levels_set"),
    )


def onehot_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns of the encoded features are set for each user, in ascending order."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = models.targets(Warehouse(spark, sf_dir)["user_features"], models.CHURN)
    encoded = Pipeline(stages=models.feature_stages(models.CHURN)).fit(rows).transform(rows)
    values = vector_to_array("features")
    levels = F.slice(values, F.lit(1), F.size(values) - len(models.CHURN.numeric))
    at = F.filter(F.transform(levels, lambda x, i: F.when(x == 1, i)), lambda i: i.isNotNull())
    return encoded.select("user_id", *[at[i].alias(f"{c}_at") for i, c in enumerate(models.CHURN.categorical)])


def _importances(spec: models.ModelSpec) -> Query:
    return lambda spark, sf_dir: models.importances(_trained(spark, sf_dir, spec)[0], spec)


def _scores(spec: models.ModelSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model, rows = _trained(spark, sf_dir, spec)
        return models.score(model, rows, spec)

    return run


def _metrics(spec: models.ModelSpec) -> Query:
    """AUC (under ``f1``) and the report, over a model's held-out users."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model, rows = _trained(spark, sf_dir, spec)
        auc, report = models.evaluate(model, rows.where(F.col("split") == "test"))
        none = F.lit(None).cast("double")
        line = auc.select(
            F.lit("test_auc").alias("entry"), none.alias("precision"), none.alias("recall"),
            F.col("auc").alias("f1"), (F.col("n_positive") + F.col("n_negative")).alias("support"),
        )
        return report.unionByName(line)

    return run


def _score_rules(spec: models.ModelSpec) -> Query:
    """Whom a model scores, whether each score lies in 0 to 1 and has its band, and whether the table of the trees'
    nodes gives the same."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model, rows = _trained(spark, sf_dir, spec)
        score, named = F.col(spec.score_col), F.col(spec.band_col)
        # the band is taken before rounding, which can move a score onto an edge
        follows = (named == band(score, spec.bands)) | score.isin(*BAND_EDGES)
        encoded = rows
        for step in model.stages[:-1]:
            encoded = step.transform(encoded)
        nodes = trees.nodes_of(model, _run_folder(spark, "trees"))
        again = trees.score_by_nodes(encoded.select("user_id", "features"), nodes, "again").select("user_id", "again")
        return models.score(model, rows, spec).join(again, "user_id").select(
            "user_id", "plan", score.between(0, 1).alias("in_range"), follows.alias("band_follows"),
            (F.abs(F.col("again") - score) <= 0.5001e-4).alias("follows_from_nodes"),
        )

    return run


def _held_out(spec: models.ModelSpec) -> Query:
    """Held-out rows by label, and whether the AUC over them is the one that Spark's evaluator finds."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from pyspark.ml.evaluation import BinaryClassificationEvaluator

        model, rows = _trained(spark, sf_dir, spec)
        test = rows.where(F.col("split") == "test")
        auc, _ = models.evaluate(model, test)
        other = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
        want = other.evaluate(models.with_probability(model, test).select("score", F.col("label").cast("double").alias("label")))
        return auc.select("n_positive", "n_negative", (F.abs(F.col("auc") - want) < 1e-9).alias("auc_agrees"))

    return run


# --- retrieval ---


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.source(spark, sf_dir, "embeddings")


def _vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build_index(_vectors(spark, sf_dir), "vec_id", vector_col="embedding")


def _self_search(match: str | None = None) -> Query:
    """Every vector is a query; its nearest row is itself."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        queries = _vectors(spark, sf_dir).withColumnRenamed("vec_id", "query_id")
        return knn.search(
            _vector_index(spark, sf_dir), queries, 5, pk="vec_id", query_id="query_id", match=match,
        )

    return run


def _stored_search(match: str | None = None) -> Query:
    """The same searches over a layout stored first: queries meet the index cell by cell."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _run_folder(spark, "layout")
        built = _vector_index(spark, sf_dir)
        knn.store_layout(knn.lay_out(built, "vec_id", match=match, k=5), path)
        queries = _vectors(spark, sf_dir).withColumnRenamed("vec_id", "query_id")
        return knn.search_layout(knn.open_layout(spark, path), queries, 5, "query_id")

    return run


def search_one_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector searches among the rows of one label: a fixed filter, before ranking."""
    queries = _vectors(spark, sf_dir).withColumnRenamed("vec_id", "query_id")
    return knn.search(
        _vector_index(spark, sf_dir), queries, 3, pk="vec_id", query_id="query_id",
        where=F.col("label") == 3,
    )


def knn_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector is a query of the coded index."""
    queries = _vectors(spark, sf_dir).withColumnRenamed("vec_id", "query_id")
    return ann.search(_vector_index(spark, sf_dir), queries, 5, pk="vec_id", query_id="query_id")


def ann_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many hits there are to be found, and whether the approximate search finds nine in ten of them."""
    found = knn.recall(knn_ann(spark, sf_dir), _self_search()(spark, sf_dir), "query_id", "vec_id")
    return found.select("n_expected", (F.col("recall") >= 0.9).alias("enough"))


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.index_stats(_vector_index(spark, sf_dir))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = proxy.source(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return tables.spread_scan(documents, "doc_id")


def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = index.build_index(_documents(spark, sf_dir), "doc_id", text_col="text")
    return built.select("doc_id", "lang", F.size("embedding").alias("n_dims"))


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of a source: labelled documents with their quality; later every document that is
    not toxic, the short ones regraded to 0."""
    documents = proxy.source(spark, sf_dir, "documents")
    labels = proxy.source(spark, sf_dir, "labels")
    graded = documents.join(labels, "doc_id", "left")
    then = graded.where(F.col("quality").isNotNull()).select(
        "doc_id", "text", F.col("quality").alias("grade")
    )
    grade = F.when(F.col("n_chars") < GRADED_CHARS, 0).otherwise(F.coalesce("quality", F.lit(0)))
    now = graded.where(F.coalesce("toxic", F.lit(0)) == 0).select(
        "doc_id", "text", grade.alias("grade")
    )
    return then, now


def index_sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    then, now = _labelled(spark, sf_dir)
    return index.sync_plan(index.build_index(then, "doc_id", text_col="text"), now, "doc_id")


def index_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    then, now = _labelled(spark, sf_dir)
    embedder = index.TextEmbedder.fit(then, "text")
    held = tables.write_table(
        index.build_index(then, "doc_id", text_col="text", embedder=embedder), _run_folder(spark, "index")
    )
    level = index.sync_index(held, now, "doc_id", text_col="text", embedder=embedder)
    return level.select("doc_id", "grade", F.size("embedding").alias("n_dims"))


def index_sync_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index following a change feed: one triggered run takes in the first state of the source,
    another what changed after it."""
    then, now = _labelled(spark, sf_dir)
    embedder = index.TextEmbedder.fit(then, "text")
    folder = _run_folder(spark, "stream")
    feed, held = f"{folder}/feed", f"{folder}/index"
    first = diff.snapshot_diff(then.limit(0), then, "doc_id")
    second = diff.snapshot_diff(then, now, "doc_id")
    for version, changes in enumerate((first, second), start=1):
        changes.withColumn("version", F.lit(version)).write.mode("append").parquet(feed)
        arriving = spark.readStream.schema(spark.read.parquet(feed).schema).parquet(feed)
        index_sync.start_sync(
            arriving, held, f"{folder}/progress", "doc_id", "text", embedder
        ).awaitTermination()
    level = index_sync.read_index(spark, held)
    return level.select("doc_id", "grade", F.size("embedding").alias("n_dims"))


def _user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What people asked, every user message."""
    said = proxy.source(spark, sf_dir, "conversations").where(F.col("role") == "user")
    said = tables.spread_scan(said, "conv_id")
    query_id = F.concat_ws("-", "conv_id", "turn")
    return said.select(query_id.alias("query_id"), "text")


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(generate.titles_for(_keys(spark, sf_dir, "part", "p_partkey"), PORTABLE))


def search_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.find_titles(_titles(spark, sf_dir), _user_turns(spark, sf_dir), "query_id")


def search_titles_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message names a genre drawn from its id; one message in six or so names none."""
    wanted = pick([*banks.GENRES, "", "", "", ""], "asked", "query_id", PORTABLE)
    asked = _user_turns(spark, sf_dir).withColumn("wanted", F.nullif(wanted, F.lit("")))
    return index.find_titles(_titles(spark, sf_dir), asked, "query_id", genre="wanted")


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand in for help articles, their language for the topic."""
    return _documents(spark, sf_dir).select("doc_id", F.col("lang").alias("title"), F.col("text").alias("body"))


def support_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = index.find_articles(_articles(spark, sf_dir), _user_turns(spark, sf_dir), "query_id")
    return found.select("query_id", "doc_id", "passage", "score", "rank")


def support_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = index.find_articles(_articles(spark, sf_dir), _user_turns(spark, sf_dir), "query_id")
    return index.article_context(found, "query_id")


def article_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_index.passages(_articles(spark, sf_dir), "doc_id", "body").drop("title")


# --- conversations ---


def _json_string(text: Column) -> Column:
    wrapped = F.to_json(F.struct(text.alias("s")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def _chat_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations the way a client sends them: user messages as blocks, other text as a string, the
    instructions under the role ``developer``."""
    text, role = F.col("text"), F.col("role")
    blocks = F.to_json(F.array(F.struct(F.lit("input_text").alias("type"), text.alias("text"))))
    return proxy.source(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.when(role == "system", "developer").otherwise(role).alias("role"),
        F.when(role == "user", blocks).otherwise(_json_string(text)).alias("content"),
    )


def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chat_items(spark, sf_dir).select(
        "conv_id", "turn", flatten_content(F.col("content")).alias("content")
    )


def normalize_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.normalize_roles(_chat_items(spark, sf_dir)).select("conv_id", "turn", "role")


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_messages(_chat_items(spark, sf_dir), SYSTEM_TEXT)


QUERIES: dict[str, Query] = {
    "scan_users": scan_users,
    "sink_roundtrip": sink_roundtrip,
    "partitioned_scan": partitioned_scan,
    "table_counts": table_counts,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_orphans": dq_orphans,
    "dq_unique_feed": dq_unique_feed,
    "dq_orphans_feed": dq_orphans_feed,
    "replaced_table": replaced_table,
    "table_preview": table_preview,
    "snapshot_diff": snapshot_diff,
    "snapshot_apply": snapshot_apply,
    "result_envelope": result_envelope,
    "result_envelope_cut": result_envelope_cut,
    "gen_pick": gen_pick,
    "gen_titles": gen_titles,
    "gen_users": gen_users,
    "gen_plays": gen_plays,
    "user_features": _table("user_features"),
    "user_features_fed": user_features_fed,
    "features_by_status": _question(metrics.features_by_status),
    "star_join": star_join,
    "user_profile": user_profile,
    "churn_by_plan": _question(metrics.churn_by_plan),
    "users_by_plan": _question(metrics.users_by_plan),
    "titles_by_genre": _question(metrics.titles_by_genre),
    "events_by_kind": _question(metrics.events_by_kind),
    "top_titles_views": _question(metrics.top_titles_views),
    "top_titles_minutes": _question(metrics.top_titles_minutes),
    "watch_by_plan": _question(metrics.watch_by_plan),
    "free_high_band": _question(metrics.free_high_band),
    "metric_churn_by_state": _question(metric_churn_by_state),
    "metric_completion_by_genre": _question(metric_completion_by_genre),
    "metric_minutes_by_plan_device": _question(metric_minutes_by_plan_device),
    "metric_payers_by_age": _question(metric_payers_by_age),
    "metric_premium_users": _question(metric_premium_users),
    "metric_high_risk_by_state": _question(metric_high_risk_by_state),
    "score_bands": score_bands,
    "band_distribution": _question(band_distribution),
    "retention_targets": _question(retention_targets),
    "upgrade_targets": _question(upgrade_targets),
    "target_churn": _target(models.churn_target),
    "target_paid": _target(models.paid_target),
    "label_base_rate": label_base_rate,
    "roc_auc": roc_auc,
    "classification_report": classification_report,
    "split_shares": split_shares,
    "split_rows": split_rows,
    "onehot_features": onehot_features,
    "onehot_positions": onehot_positions,
    "train_churn": _importances(models.CHURN),
    "train_upgrade": _importances(models.UPGRADE),
    "score_churn": _scores(models.CHURN),
    "score_upgrade": _scores(models.UPGRADE),
    "model_metrics": _metrics(models.CHURN),
    "upgrade_metrics": _metrics(models.UPGRADE),
    "score_rules_churn": _score_rules(models.CHURN),
    "score_rules_upgrade": _score_rules(models.UPGRADE),
    "upgrade_held_out": _held_out(models.UPGRADE),
    "knn_exact": _self_search(),
    "search_filtered": _self_search(match="label"),
    "knn_stored": _stored_search(),
    "search_stored": _stored_search(match="label"),
    "search_one_label": search_one_label,
    "knn_ann": knn_ann,
    "ann_recall": ann_recall,
    "index_stats": index_stats,
    "index_documents": index_documents,
    "index_sync_plan": index_sync_plan,
    "index_synced": index_synced,
    "index_sync_stream": index_sync_stream,
    "search_titles": search_titles,
    "search_titles_by_genre": search_titles_by_genre,
    "support_hits": support_hits,
    "support_context": support_context,
    "article_passages": article_passages,
    "flatten_content": flatten,
    "normalize_roles": normalize_roles,
    "chat_messages": chat_messages,
}
