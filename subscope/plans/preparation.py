"""The whole data set of one participant: generated tables, features, scores and search indexes.

State passes from step to step through stored tables only, so any step can be run again by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subscope.operators import features, index, models
from subscope.settings import Settings, cut
from subscope.sources import generate
from subscope.sources.tables import ensure_schema, path_exists, read_table, write_table

TABLES = (
    "titles", "users", "plays", "help_articles", "user_features", "churn_scores", "upgrade_scores",
    "titles_index", "help_index",
)


def generate_tables(
    spark: SparkSession,
    place: Settings,
    n_users: int = generate.N_USERS,
    n_titles: int = generate.N_TITLES,
    n_plays: int = generate.N_PLAYS,
) -> None:
    ensure_schema(spark, place.database)
    latent = generate.gen_users_latent(spark, place.as_of, n_users, n_plays)
    plays = generate.gen_plays(latent, place.as_of, n_titles)
    write_table(generate.gen_titles(spark, n_titles), place.table("titles"))
    write_table(generate.gen_users(latent), place.table("users"))
    write_table(plays, place.table("plays"), partition_by=["event"])
    write_table(generate.gen_help(spark), place.table("help_articles"))


def build_features(spark: SparkSession, place: Settings) -> DataFrame:
    users, plays, titles = (read_table(spark, place.table(t)) for t in ("users", "plays", "titles"))
    made = features.user_features(users, plays, titles, place.as_of)
    return write_table(made, place.table("user_features"))


def train_and_score(
    spark: SparkSession, place: Settings, spec: models.ModelSpec, rounds: int = models.ROUNDS,
    model_path: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored scores of the base, the test AUC and the classification report."""
    stored = read_table(spark, place.table("user_features"))
    rows = models.split(models.targets(stored, spec), "user_id", seed=place.seed)
    model = models.fit(rows.where("split = 'train'"), spec, rounds)
    if model_path is not None:
        models.save(model, model_path)
    scores = write_table(models.score(model, stored, spec), place.table(f"{spec.name}_scores"))
    return scores, *models.evaluate(model, rows.where("split = 'test'"))


def build_indexes(
    spark: SparkSession, place: Settings, embedders_path: str | None = None
) -> dict[str, index.TextEmbedder]:
    """Titles by their synopsis, help articles by their body: created, or brought level where they are there.

    The embedders, which queries need too, are returned, and kept in ``embedders_path`` if a folder is
    given. An index whose embedder is kept there is brought level by it: only rows that are new or have changed are
    embedded. Without it the index is made anew.
    """
    made = {}
    for source, pk, text in (("titles", "content_id", "synopsis"), ("help_articles", "doc_id", "body")):
        rows = read_table(spark, place.table(source))
        name = source.removesuffix("_articles")
        target, kept = place.table(f"{name}_index"), embedders_path and f"{embedders_path}/{name}"
        if kept and spark.catalog.tableExists(target) and path_exists(spark, kept):
            made[name] = index.TextEmbedder.load(kept)
            # the table is read while it is replaced, so what will be in it is stored first
            level = cut(index.sync_index(read_table(spark, target), rows, pk, text_col=text, embedder=made[name]))
            write_table(level, target)
            continue
        made[name] = index.TextEmbedder.fit(rows, text)
        write_table(index.build_index(rows, pk, text_col=text, embedder=made[name]), target)
        if kept:
            made[name].save(kept)
    return made


def prepare(
    spark: SparkSession,
    place: Settings,
    n_users: int = generate.N_USERS,
    n_titles: int = generate.N_TITLES,
    n_plays: int = generate.N_PLAYS,
    rounds: int = models.ROUNDS,
    embedders_path: str | None = None,
) -> dict[str, DataFrame]:
    """Every step in order; the stored tables by name."""
    generate_tables(spark, place, n_users, n_titles, n_plays)
    build_features(spark, place)
    for spec in (models.CHURN, models.UPGRADE):
        train_and_score(spark, place, spec, rounds)
    build_indexes(spark, place, embedders_path)
    return {name: read_table(spark, place.table(name)) for name in TABLES}
