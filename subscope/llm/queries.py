"""The registered queries of the training-text operators, over whole tables with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.llm import (
    bpe, decontamination, exact_dedup, hard_negatives, language_id, line_dedup, lm_scoring, near_dedup, packing, prefix_trie,
    quality_rules, token_counts, token_files,
)
from subscope.llm.stage import stored
from subscope.settings import cut, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), n=4)


def packed(docs: DataFrame) -> DataFrame:
    """Where each document's pieces go, with a checksum of their ids."""
    pieces = packing.token_pieces(docs, WORD_BPE)
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    held = cut(digest.withColumn("row", F.monotonically_increasing_id()))
    return held.join(packing.pack(held), "row").drop("row")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(documents(spark, sf_dir), WORD_BPE, _folder(spark, "tokens"))
    return files.documents(spark)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir), "crc32(cast(doc_id as string)) % 5 = 1")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), WORD_BPE)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(bpe.encode_decode(documents(spark, sf_dir), BYTE_BPE))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), keep="largest")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    net = language_id.learn(docs.where(~held_out))
    return language_id.predict(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).drop("who", "boilerplate")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _respliced(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``seq, depth, digest, weight`` of conversations rebuilt: the first turns of the least of five, then their own.

    Conversation c takes ``crc32(c) % 9`` turns of ``c - c % 5``, as far as there are, and as many of its own go.
    """
    takes = (F.crc32(F.col("seq").cast("string")) % 9).alias("takes")
    held = lengths.select("seq", (F.col("seq") - F.col("seq") % 5).alias("base"), takes)
    held = held.join(lengths.select(F.col("seq").alias("base"), "n"), "base", "left")
    taken = F.least("takes", F.coalesce("n", F.lit(0)))
    own = turns.join(held.select("seq", "takes", taken.alias("taken")), "seq").where(F.col("at") >= F.col("takes"))
    own = own.select("seq", (F.col("at") - F.col("takes") + F.col("taken") + 1).alias("depth"), "digest", "weight")
    lent = turns.where((F.col("seq") % 5 == 0) & (F.col("at") < 9)).withColumnRenamed("seq", "base")
    lent = lent.join(held.select("seq", "base", "takes"), "base").where(F.col("at") < F.col("takes"))
    return own.unionByName(lent.select("seq", (F.col("at") + 1).alias("depth"), "digest", "weight"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, lengths = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    turns = stored(turns)
    made = prefix_trie.trie(_respliced(turns, lengths), lengths.select("seq"))
    ends = prefix_trie.ends_digest(made.ends)
    return made.nodes.join(ends, "name", "left").select(
        F.col("seq").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n_members").alias("n_convs"),
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
        "positive_score", "negative_score",
    )


QUERIES: dict[str, Query] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_packing": op2_packing,
    "op3_token_files": op3_token_files,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_token_counts": op5_token_counts,
    "op6_bpe": op6_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_decontamination": op11_decontamination,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The unsigned crc32 of conv_id as text, byte by byte and bit by bit.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, b: list_reduce(
        list_prepend(xor(crc, b), range(8)::UBIGINT[]), lambda r, i: xor(r >> 1, 3988292384::UBIGINT * (r & 1::UBIGINT)))
    ), 4294967295::UBIGINT)::BIGINT"""
_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE: dict[str, str] = {
    "op7_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM t JOIN g USING (body)
    """,
    "op11_decontamination": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        needles AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS body
            FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0
        ),
        places AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS body
            FROM docs, (SELECT DISTINCT n FROM needles) AS s, unnest(range(1, len(w) + 1)) AS t(i) WHERE i + n - 1 <= len(w)
        ),
        met AS (SELECT r, i, p.n, item_id FROM places AS p JOIN needles AS d ON p.body = d.body AND p.n = d.n),
        words AS (
            SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT r, i, n FROM met) AS m, unnest(range(i, i + n)) AS t(place)
            GROUP BY r
        ),
        found AS (
            SELECT r, count(DISTINCT item_id) AS n_items,
                array_to_string(list_sort(list(DISTINCT item_id::VARCHAR) FILTER (item_id IS NOT NULL)), ',') AS ids
            FROM met GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)
    """,
    "op12_prefix_trie": f"""
        WITH RECURSIVE turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
                sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest,
                strlen(coalesce(text, '')) AS weight
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        convs AS (SELECT DISTINCT conv_id, ({_CRC32}) % 9 AS h, conv_id - conv_id % 5 AS base FROM turns),
        joined AS (
            SELECT c.conv_id, 0 AS own, place, digest, weight FROM convs AS c JOIN turns AS t ON t.conv_id = c.base AND place <= h
            UNION ALL
            SELECT c.conv_id, 1, place, digest, weight FROM convs AS c JOIN turns AS t ON t.conv_id = c.conv_id AND place > h
        ),
        paths AS (
            SELECT conv_id, row_number() OVER w AS depth, weight, string_agg(digest, '') OVER w AS name
            FROM joined WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)
            UNION ALL SELECT conv_id, 0, 0, '' FROM convs
        ),
        ends AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY 1),
        nodes AS (
            SELECT p.name, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(weight) AS weight,
                coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (e.depth = p.depth), '') AS ids
            FROM paths AS p JOIN ends AS e USING (conv_id) GROUP BY 1, 2
        ),
        above AS (
            SELECT n.*, u.conv_id AS parent, (SELECT count(*) FROM nodes AS d WHERE d.depth = n.depth + 1 AND d.name[1:64 * n.depth] = n.name) AS n_children
            FROM nodes AS n LEFT JOIN nodes AS u ON u.depth = n.depth - 1 AND u.name = n.name[1:64 * (n.depth - 1)]
        )
        SELECT a.conv_id, a.depth::BIGINT AS depth, a.parent AS parent_conv_id, a.n_convs, a.n_children,
            count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.weight)::BIGINT AS saved_tokens,
            sha256(a.ids) AS ends_sha256
        FROM above AS a JOIN above AS b ON b.depth >= a.depth AND b.name[1:64 * a.depth] = a.name
        GROUP BY a.conv_id, a.depth, a.parent, a.n_convs, a.n_children, a.ids
    """,
    "op13_hard_negatives": """
        WITH whole AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scores AS (
            SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS other, b.label = a.label AS same, b.r AS other_r,
                list_dot_product(a.v, b.v)::BIGINT AS score
            FROM whole AS a, whole AS b WHERE a.vec_id % 50 = 0 AND a.r <> b.r
        ),
        positives AS (
            SELECT r, anchor_id, other AS positive_id, other_r AS p, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, other) <= 5
        ),
        ranked AS (
            SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
                row_number() OVER (PARTITION BY p.r, p ORDER BY score DESC, other)::INTEGER AS rank
            FROM positives AS p JOIN scores AS s ON s.r = p.r AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
    """,
}
