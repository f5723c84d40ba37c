"""A vector index kept as a table: one row per source row, with its vector and a fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.functions.bitmaps import mark, maybe_in
from subscope.functions.hashing import row_hash
from subscope.operators import text_index
from subscope.operators.diff import DELETE, change_kind
from subscope.operators.knn import search
from subscope.settings import cut
from subscope.sources.tables import write_table

DIMENSIONS = 256
TITLE_HITS, HELP_HITS, SYNOPSIS_CHARS = 6, 3, 180


class TextEmbedder:
    """Texts to unit vectors: hashed word counts weighted by rarity. Any object with ``embed`` and the
    same signature can stand in for it."""

    def __init__(self, model: PipelineModel):
        self._model = model

    @classmethod
    def fit(cls, texts: DataFrame, text_col: str, dimensions: int = DIMENSIONS) -> TextEmbedder:
        stages = [
            RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
            IDF(inputCol="_counts", outputCol="_weights"),
            Normalizer(inputCol="_weights", outputCol="_unit"),
        ]
        return cls(Pipeline(stages=stages).fit(texts.select(_text(text_col))))

    def embed(self, df: DataFrame, text_col: str, output: str = "embedding") -> DataFrame:
        helpers = ["_text", "_words", "_counts", "_weights", "_unit"]
        vectors = self._model.transform(df.withColumn("_text", _plain(text_col)))
        return vectors.withColumn(output, vector_to_array("_unit", "float32")).drop(*helpers)

    def save(self, path: str) -> None:
        self._model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> TextEmbedder:
        return cls(PipelineModel.load(path))


def _plain(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _text(text_col: str) -> Column:
    return _plain(text_col).alias("_text")


def _fingerprinted(source: DataFrame, pk: str, carry: Sequence[str] = ()) -> DataFrame:
    # in the order of their names, so that a source with its columns moved is the same source
    content = sorted(c for c in source.columns if c != pk and c not in carry)
    return source.withColumn("content_hash", row_hash(content))


def _embedded(
    rows: DataFrame, text_col: str | None, vector_col: str | None, embedder: TextEmbedder | None
) -> DataFrame:
    if vector_col is not None:
        return rows.withColumnRenamed(vector_col, "embedding")
    if text_col is None or embedder is None:
        raise ValueError("name a vector column, or a text column and an embedder")
    return embedder.embed(rows, text_col)


def build_index(
    source: DataFrame,
    pk: str,
    text_col: str | None = None,
    vector_col: str | None = None,
    embedder: TextEmbedder | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``source`` with ``embedding`` and ``content_hash``. The vectors come from ``vector_col``, or
    from ``text_col``, whole, through the embedder (fitted on the source when none is given). Columns in
    ``carry`` come along without being part of the content."""
    if vector_col is None and text_col is not None and embedder is None:
        embedder = TextEmbedder.fit(source, text_col)
    return _embedded(_fingerprinted(source, pk, carry), text_col, vector_col, embedder)


def sync_plan(index: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """``pk, change`` for every source row the index has to catch up with."""
    held = index.select(pk, F.col("content_hash").alias("_old"))
    current = _fingerprinted(source, pk).select(pk, F.col("content_hash").alias("_new"))
    return (
        held.join(current, pk, "full_outer")
        .select(pk, change_kind(F.col("_old"), F.col("_new")).alias("change"))
        .where(F.col("change").isNotNull())
    )


def sync_index(
    index: DataFrame,
    source: DataFrame,
    pk: str,
    text_col: str | None = None,
    vector_col: str | None = None,
    embedder: TextEmbedder | None = None,
) -> DataFrame:
    """The index brought level with the source; only new and changed rows are embedded.

    Keys and fingerprints decide. Rows of the index that did not change stay where they are, and rows of
    the source that did not change are not moved either: a bitmap of the changed keys tells them apart.
    """
    changes = cut(sync_plan(index, source, pk))
    told = mark(index, changes, pk, "_maybe")
    unchanged = told.where("not _maybe").unionByName(told.where("_maybe").join(changes.select(pk), pk, "left_anti"))
    arriving = changes.where(F.col("change") != DELETE).select(pk)
    changed = maybe_in(_fingerprinted(source, pk), arriving, pk).join(arriving, pk, "left_semi")
    fresh = _embedded(changed, text_col, vector_col, embedder)
    return unchanged.select(*index.columns).unionByName(fresh.select(*index.columns))


def create_or_sync(
    spark: SparkSession, path: str, source: DataFrame, pk: str, text_col: str | None = None,
    vector_col: str | None = None, embedder: TextEmbedder | None = None,
) -> DataFrame:
    """The index of ``source``, built where there is none yet at ``path``, else the stored one brought level.

    Each call writes a table of its own under ``path`` and then names it in ``current``, so readers never see
    one half written.
    """
    try:
        held = spark.read.parquet(f"{path}/current").orderBy(F.desc("number")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        held = None
    if held is None:
        number, made = 0, build_index(source, pk, text_col, vector_col, embedder)
    else:
        number = held["number"] + 1
        made = sync_index(spark.read.parquet(f"{path}/{held['number']}"), source, pk, text_col, vector_col, embedder)
    stored = write_table(made, f"{path}/{number}")
    spark.createDataFrame([(number,)], "number long").coalesce(1).write.mode("append").parquet(f"{path}/current")
    return stored


def index_stats(index: DataFrame, vector: str = "embedding") -> DataFrame:
    """``n_rows, n_null_vectors, min_dims, max_dims, ready``: ready when every row has a vector and
    all have the same length."""
    dims = F.size(vector)
    has = F.col(vector).isNotNull()
    return index.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~has).alias("n_null_vectors"),
        F.min(F.when(has, dims)).alias("min_dims"),
        F.max(F.when(has, dims)).alias("max_dims"),
    ).withColumn(
        "ready",
        (F.col("n_rows") > 0) & (F.col("n_null_vectors") == 0) & (F.col("min_dims") == F.col("max_dims")),
    )


def with_payload(hits: DataFrame, index: DataFrame, pk: str, columns: Sequence[str | Column]) -> DataFrame:
    """The hits with columns of the rows they hit."""
    named = [F.col(c) if isinstance(c, str) else c for c in columns]
    return hits.join(index.select(pk, *named), pk)


def title_details() -> list[str | Column]:
    """What a title is shown with: ten columns, the synopsis cut to 180 characters."""
    return [
        "title", "kind", "genre", "year", F.col("score_avg").alias("rating"), "director", "cast_names",
        "duration_min", "seasons",
        F.substring(F.coalesce("synopsis", F.lit("")), 1, SYNOPSIS_CHARS).alias("synopsis"),
    ]


def search_titles(
    index: DataFrame, queries: DataFrame, query_id: str, k: int = TITLE_HITS, genre: str | None = None, **options
) -> DataFrame:
    """The titles that suit each query, by their vectors, with ``title_details``.

    ``genre`` names a column of the queries: where it is set, only titles of that genre are ranked.
    """
    asked = queries if genre is None else queries.withColumn("genre", F.col(genre))
    hits = search(
        index, asked, k, pk="content_id", query_id=query_id, match="genre" if genre else None, **options
    )
    return with_payload(hits, index, "content_id", title_details())


def find_titles(
    titles: DataFrame, queries: DataFrame, query_id: str, k: int = TITLE_HITS, genre: str | None = None,
    held: text_index.TextIndex | None = None,
) -> DataFrame:
    """``search_titles`` by the words of the synopsis: only titles that share a word with the query are found, and of the others nothing travels."""
    held = held or text_index.build(titles, "content_id", "synopsis", group="genre")
    hits = cut(text_index.search(held, queries, k, query_id=query_id, group=genre).select(
        F.col("q").alias(query_id), F.col("unit").alias("content_id"), "score", "rank"
    ))
    return with_payload(hits, maybe_in(titles, hits, "content_id"), "content_id", title_details())


def find_articles(articles: DataFrame, queries: DataFrame, query_id: str, k: int = HELP_HITS) -> DataFrame:
    """``query_id, doc_id, passage, score, rank, topic, body``: the articles that suit each query, each by its best passage.

    An article of any length is cut into passages that overlap, and ranks by the one that suits best. Passages are
    cut anew wherever they are read, and only those that are hit travel.
    """
    cut_up = text_index.passages(articles, "doc_id", "body").withColumn("unit", F.struct("doc_id", "passage"))
    held = text_index.build(cut_up, "unit", "body", pool="doc_id")
    hits = cut(text_index.search(held, queries, k, query_id=query_id))
    return hits.join(maybe_in(cut_up, hits, "unit"), "unit").select(
        F.col("q").alias(query_id), "doc_id", "passage", "score", "rank", F.col("title").alias("topic"), "body"
    )


def article_context(hits: DataFrame, query_id: str) -> DataFrame:
    """``query_id, n_hits, context``: the hits of each query as one text, best first."""
    part = F.struct("rank", F.concat_ws("\n", "topic", "body").alias("text"))
    gathered = hits.groupBy(query_id).agg(
        F.count("*").alias("n_hits"), F.sort_array(F.collect_list(part)).alias("parts")
    )
    return gathered.select(
        query_id, "n_hits", F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n").alias("context")
    )


def support_hits(
    index: DataFrame, queries: DataFrame, query_id: str, k: int = HELP_HITS, **options
) -> DataFrame:
    """The help articles that suit each query: topic and body."""
    hits = search(index, queries, k, pk="doc_id", query_id=query_id, **options)
    return with_payload(hits, index, "doc_id", [F.col("title").alias("topic"), "body"])


def support_context(
    index: DataFrame, queries: DataFrame, query_id: str, k: int = HELP_HITS, **options
) -> DataFrame:
    """``query_id, n_hits, context``: the ``k`` articles of each query as one text, best first."""
    return article_context(support_hits(index, queries, query_id, k, **options), query_id)
