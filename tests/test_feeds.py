"""State that takes in feeds, checks of feeds alone, trees as a table, texts by their words."""

import datetime as dt
import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from subscope.functions import bitmaps
from subscope.operators import features, models, quality, text_index, trees
from subscope.plans.workload import Warehouse

AS_OF = dt.date(2024, 1, 31)


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


# --- features ---


def test_states_of_three_feeds_make_the_features_of_all(spark, sf_dir):
    held = Warehouse(spark, sf_dir)
    users, plays, titles = held["users"], held["plays"], held["titles"]
    plays = plays.unionByName(plays.limit(1).withColumns({
        "user_id": F.lit("U0000001"), "pct_watched": F.lit(None).cast("double"), "watch_min": F.lit(None).cast("int"),
        "device": F.lit(None).cast("string"), "content_id": F.lit("unknown"),
    }))
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    states = [features.engagement_state(plays.where(third == i), titles) for i in range(3)]
    nested = features.merge_states(features.merge_states(*states[:2]), states[2])
    want = rows(features.user_features(users, plays, titles, AS_OF))
    assert rows(features.features_of(users, features.merge_states(*states), AS_OF)) == want
    assert rows(features.features_of(users, nested, AS_OF)) == want
    empty = features.engagement_state(plays.limit(0), titles)
    assert rows(features.features_of(users, features.merge_states(*states, empty), AS_OF)) == want


# --- checks ---

TABLE = [(1, "a"), (1, "a"), (2, "b"), (3, None), (None, None), (4, "d")]
FEED = [(2, "b"), (3, None), (3, "x"), (None, None), (5, "e"), (5, "e"), (6, "f")]


def test_unique_check_of_a_feed(spark):
    table, feed = (spark.createDataFrame(x, "k long, s string") for x in (TABLE, FEED))
    state = quality.checked_unique(table, ["k", "s"])
    for more in (feed, feed.limit(0), table):
        found = quality.check_unique_feed(table, state, more, ["k", "s"])
        assert rows(found) == rows(quality.check_unique(table.unionByName(more), ["k", "s"]))
    nothing = quality.checked_unique(table.limit(0), ["k", "s"])
    assert rows(quality.check_unique_feed(table.limit(0), nothing, feed, ["k", "s"])) == rows(quality.check_unique(feed, ["k", "s"]))


def test_reference_check_of_a_feed(spark):
    child, feed = (spark.createDataFrame(x, "k long, s string") for x in (TABLE, FEED))
    parent = spark.createDataFrame([(1,), (2,), (2,), (6,)], "k long")
    state = quality.checked_reference(child, parent, "k")
    found = quality.check_foreign_key_feed(state, parent, feed, "k")
    assert rows(found) == rows(quality.check_foreign_key(child.unionByName(feed), parent, "k"))
    more = spark.createDataFrame([(3,), (5,)], "k long")
    found = quality.check_foreign_key_feed(state, parent, feed, "k", more)
    assert rows(found) == rows(quality.check_foreign_key(child.unionByName(feed), parent.unionByName(more), "k"))


def test_bitmaps_are_merged(spark):
    a, b = spark.range(0, 500), spark.range(400, 900)
    whole = bitmaps.key_bits(a.union(b), "id")
    merged = bitmaps.merged_bits(bitmaps.key_bits(a, "id"), bitmaps.key_bits(b, "id"))
    assert rows(whole) == rows(merged)
    told = bitmaps.mark_by(spark.range(0, 2000), merged, "id").where("maybe")
    assert told.where("id < 900").count() == 900 and told.count() < 905


# --- trees ---


def test_scores_from_the_nodes_are_the_model_s(spark, tmp_path):
    draw = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000
    base = spark.range(400).select(
        F.col("id").cast("string").alias("user_id"), F.element_at(F.array(*map(F.lit, "abc")), (F.col("id") % 3 + 1).cast("int")).alias("plan"),
        *[(draw * i + F.col("id") % (i + 2)).alias(c) for i, c in enumerate(models.NUMERIC)],
        F.when((draw + F.col("id") % 3 * 0.3) > 0.8, 1).otherwise(0).alias("label"),
    )
    spec = models.ModelSpec("churn", ("plan",), "prob_churn", "risk_band", models.RISK_BANDS, keep=("user_id",))
    model = models.fit(base, spec, rounds=12)
    nodes = trees.nodes_of(model, f"{tmp_path}/trees").cache()
    assert nodes.select("tree").distinct().count() == 12 and nodes.where("level is not null").count() > 0
    want = {r["user_id"]: r["score"] for r in models.with_probability(model, base).collect()}
    encoded = base
    for stage in model.stages[:-1]:
        encoded = stage.transform(encoded)
    found = trees.score_by_nodes(encoded, nodes).select("user_id", "score").collect()
    assert len(found) == 400 and all(abs(r["score"] - want[r["user_id"]]) < 1e-12 for r in found)

    # the same scores by another engine, from the stored table of nodes
    nodes.write.parquet(f"{tmp_path}/nodes")
    from pyspark.ml.functions import vector_to_array

    encoded.select("user_id", vector_to_array("features").alias("x")).write.parquet(f"{tmp_path}/x")
    again = duckdb.sql(f"""
        WITH RECURSIVE nodes AS (SELECT * FROM '{tmp_path}/nodes/*.parquet'),
        walk AS (
            SELECT user_id, x, tree, 0 AS node FROM '{tmp_path}/x/*.parquet', (SELECT DISTINCT tree FROM nodes)
            UNION ALL
            SELECT user_id, x, w.tree, CASE WHEN coalesce(x[feature + 1] = level, x[feature + 1] <= threshold) THEN yes ELSE no END
            FROM walk AS w JOIN nodes AS n ON n.tree = w.tree AND n.node = w.node WHERE yes IS NOT NULL)
        SELECT user_id, 1 / (1 + exp(-2 * sum(weight * prediction))) FROM walk AS w JOIN nodes AS n ON n.tree = w.tree AND n.node = w.node
        WHERE yes IS NULL GROUP BY user_id""").fetchall()
    assert len(again) == 400 and all(abs(score - want[user]) < 1e-9 for user, score in again)


# --- texts ---

TEXTS = [
    ("a", "o mar e a lua", "x"), ("b", "O MAR", "y"), ("c", None, "x"), ("d", " -- ", "x"), ("e", "lua lua lua cheia", "y"),
    ("f", "o rio e o mar e o rio", None), ("g", "cidade 42", "x"), ("h", "o mar", "y"), *((f"k{i}", "o rio comum " + "mar " * (i % 3), "x") for i in range(40)),
]
ASKED = [(1, "mar", None), (2, "lua do mar", "y"), (3, None, None), (4, "nada disso", "x"), (5, "rio comum 42 o", "x"), (6, "o", None), (7, "LUA", "nope")]


def by_words(texts, asked, k):
    bits = lambda n: n.bit_length()
    words = {key: Counter(re.findall(r"[^\W_]+", (t or "").lower())) for key, t, _ in texts}
    often = Counter(w for c in words.values() for w in c)
    rare = {w: int(math.floor(100 * math.log(1 + len(texts) / n) + 0.5)) for w, n in often.items()}
    held = {key: {w: bits(n) * rare[w] for w, n in c.items()} for key, c in words.items()}
    found = []
    for q, text, wanted in asked:
        ask = {w: bits(n) * rare[w] for w, n in Counter(re.findall(r"[^\W_]+", (text or "").lower())).items() if w in rare}
        scores = []
        for key, _, group in texts:
            dot = sum(v * held[key].get(w, 0) for w, v in ask.items())
            if dot and (wanted is None or wanted == group):
                scores.append((-dot / (math.sqrt(sum(v * v for v in ask.values())) * math.sqrt(sum(v * v for v in held[key].values()))), key))
        found += [(q, key, -s, rank) for rank, (s, key) in enumerate(sorted(scores)[:k], 1)]
    return found


@pytest.mark.parametrize("first", [64, 3])
def test_search_by_words_is_brute_force(spark, monkeypatch, first):
    monkeypatch.setattr(text_index, "FIRST_TEXTS", first)
    texts = spark.createDataFrame(TEXTS, "id string, body string, kind string")
    asked = spark.createDataFrame(ASKED, "q string, text string, wanted string")
    held = text_index.build(texts, "id", "body", group="kind")
    for group in (None, "wanted"):
        found = text_index.search(held, asked, 4, query_id="q", group=group)
        want = by_words(TEXTS, [(q, t, w if group else None) for q, t, w in ASKED], 4)
        got = sorted((int(r["q"]), r["rank"], r["unit"], r["score"]) for r in found.collect())
        assert [g[:3] for g in got] == [(q, rank, key) for q, key, _, rank in sorted(want, key=lambda x: (x[0], x[3]))]
        assert [g[3] for g in got] == pytest.approx([s for _, _, s, _ in sorted(want, key=lambda x: (x[0], x[3]))])
    assert text_index.search(held, asked.limit(0), 4, query_id="q").count() == 0
    assert text_index.search(text_index.build(texts.limit(0), "id", "body"), asked, 4, query_id="q").count() == 0


def test_passages_overlap_and_cover(spark):
    texts = {1: " ".join(f"w{i}" for i in range(500)), 2: "a b\tc\n\nd", 3: None, 4: "  ", 5: " ".join(f"w{i}" for i in range(120)), 6: "x " * 121}
    df = spark.createDataFrame(list(texts.items()), "id int, t string").withColumn("passage_of", F.lit(1))
    found = text_index.passages(df, "id", "t").orderBy("id", "passage").collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r["id"], []).append((r["passage"], r["n_words"], r["body"].split(" ")))
    assert [(p, n) for p, n, _ in by_id[1]] == [(0, 120), (60, 120), (120, 120), (180, 120), (240, 120), (300, 120), (360, 120), (420, 80)]
    assert all(body == [f"w{i}" for i in range(p, p + n)] for p, n, body in by_id[1])
    assert by_id[2] == [(0, 4, list("abcd"))] and set(by_id) == {1, 2, 5, 6}
    assert [(p, n) for p, n, _ in by_id[5]] == [(0, 120)] and [(p, n) for p, n, _ in by_id[6]] == [(0, 120), (60, 61)]


@pytest.mark.parametrize("rare", [False, True])
def test_a_block_hands_on_k_texts_of_a_query(spark, monkeypatch, rare):
    """All texts share words with all queries; what moves is a few texts for each query and block, in full and in order."""
    words = "a de que um rei mar sol lua".split()
    said = lambda i: " ".join([w for j, w in enumerate(words) if (i * 7 + j * j) % 3] + ([f"w{i % 40}", f"v{i % 11}"] if rare else []))
    texts = [(f"t{i:03}", said(i), "gh"[i % 2]) for i in range(300)]
    asked = [(i, said(i * 5 + 1), None if i % 3 else "g") for i in range(20)]
    handed = spark.sparkContext.accumulator(0)
    plain = text_index._scorer

    def watched(*args):
        score = plain(*args)

        def run(asks, units):
            found = score(asks, units)
            handed.add(found.num_rows)
            return found

        return run

    monkeypatch.setattr(text_index, "_scorer", watched)
    monkeypatch.setattr(text_index, "BLOCK_TEXTS", 100)
    held = text_index.build(spark.createDataFrame(texts, "id string, body string, kind string"), "id", "body", group="kind")
    assert held.blocks == 3
    found = text_index.search(held, spark.createDataFrame(asked, "q int, text string, wanted string"), 4, query_id="q", group="wanted").collect()
    want = {(q, rank): (key, score) for q, key, score, rank in by_words(texts, asked, 4)}
    assert {(r["q"], r["rank"]): r["unit"] for r in found} == {at: key for at, (key, _) in want.items()}
    assert all(r["score"] == pytest.approx(want[r["q"], r["rank"]][1]) for r in found)
    assert handed.value <= 4 * 3 * 20


def test_scores_from_the_nodes_join_nothing(spark):
    """A stump on a number and one on a level; the ensemble goes to the rows as arrays."""
    from pyspark.ml.functions import array_to_vector

    kinds = "tree int, weight double, node int, prediction double, yes int, no int, feature int, threshold double, level double"
    rows = [(0, 1.0, 0, 0.0, 1, 2, 1, 0.5, None), (0, 1.0, 1, 0.25, None, None, None, None, None), (0, 1.0, 2, -0.5, None, None, None, None, None),
            (1, 0.1, 0, 0.0, 1, 2, 0, None, 1.0), (1, 0.1, 1, 2.0, None, None, None, None, None), (1, 0.1, 2, 3.0, None, None, None, None, None)]
    x = spark.createDataFrame([(1, [1.0, 0.5]), (2, [0.0, 0.6]), (3, [0.0, float("nan")])], "id int, x array<double>")
    scored = trees.score_by_nodes(x.withColumn("features", array_to_vector("x")), spark.createDataFrame(rows, kinds))
    assert "Join" not in scored._jdf.queryExecution().executedPlan().toString()
    margins = {1: 0.25 + 0.2, 2: -0.5 + 0.1 * 3.0, 3: -0.5 + 0.1 * 3.0}
    assert {r["id"]: r["score"] for r in scored.collect()} == pytest.approx({i: 1 / (1 + math.exp(-2 * m)) for i, m in margins.items()})


def test_a_query_goes_from_pack_to_pack_with_what_must_be_reached(spark, monkeypatch):
    """Later packs hand on only what comes among the best so far, also if many texts are alike."""
    words = "a de que um rei mar sol lua".split()
    said = lambda i: " ".join([w for j, w in enumerate(words) if (i * 7 + j * j) % 3] + [f"w{i % 40}", f"v{i % 11}"])
    texts = [(f"t{i:03}", said(i % 500), "gh"[i % 2]) for i in range(600)]
    asked = [(i, said(i * 5 + 1), None if i % 3 else "g") for i in range(60)]
    handed = spark.sparkContext.accumulator(0)
    plain = text_index._scorer

    def watched(*args):
        score = plain(*args)

        def run(asks, units):
            found = score(asks, units)
            handed.add(found.num_rows)
            return found

        return run

    monkeypatch.setattr(text_index, "_scorer", watched)
    monkeypatch.setattr(text_index, "BLOCK_TEXTS", 100)
    monkeypatch.setattr(text_index, "BLOCK_QUERIES", 4)  # as many blocks of queries as there are tasks
    held = text_index.build(spark.createDataFrame(texts, "id string, body string, kind string"), "id", "body", group="kind")
    found = text_index.search(held, spark.createDataFrame(asked, "q int, text string, wanted string"), 4, query_id="q", group="wanted").collect()
    want = {(q, rank): (key, score) for q, key, score, rank in by_words(texts, asked, 4)}
    assert {(r["q"], r["rank"]): r["unit"] for r in found} == {at: key for at, (key, _) in want.items()}
    assert all(r["score"] == pytest.approx(want[r["q"], r["rank"]][1]) for r in found)
    assert held.blocks == 6 and handed.value < 4 * 6 * 60 * 0.75


def test_texts_of_one_key_are_one(spark):
    """Rows of a repeated key are searched as one text; rows without a key only make their words less rare."""
    texts = [("a", "mar lua", "x"), ("a", "mar sol", "x"), ("b", "lua", "x"), ("a", "sol", "y"), (None, "lua", "x"), (None, "lua lua", "x"), ("c", None, "x")]
    held = text_index.build(spark.createDataFrame(texts, "id string, body string, kind string"), "id", "body", group="kind")
    found = text_index.search(held, spark.createDataFrame([(1, "lua sol", None), (2, "sol", "y")], "q int, text string, wanted string"), 4, query_id="q", group="wanted")
    rare = lambda n: int(math.floor(100 * math.log(1 + 7 / n) + 0.5))
    lua, sol, mar = rare(3), rare(2), rare(1)
    length = lambda *w: math.sqrt(sum(x * x for x in w))
    both = (lua * lua + sol * sol) / (length(2 * mar, lua, sol) * length(lua, sol))
    want = {(1, "a"): max(both, sol / length(lua, sol)), (1, "b"): lua / length(lua, sol), (2, "a"): 1.0}
    assert {(r["q"], r["unit"]): r["score"] for r in found.collect()} == pytest.approx(want)


def test_a_search_of_passages_keeps_less_than_twice_the_texts(spark):
    """Neither the passages nor their postings are kept or sent as rows: only packs of them, and what distinct words need."""
    from pathlib import Path

    from subscope.operators import index
    from subscope.settings import shared_folder

    words = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("lha", "no", "ra", "", "ste", "ver")]
    said = lambda i, n: " ".join(words[(i * 31 + j * j * 7 + i * j) % len(words)] for j in range(n))
    texts = [(i, "t", said(i, 700)) for i in range(600)]
    folder = Path(shared_folder(spark).removeprefix("file:"))
    used = lambda: sum(x.stat().st_size for x in folder.rglob("*") if x.is_file())
    asked = spark.createDataFrame([(i, said(i * 3 + 1, 9)) for i in range(40)], "q int, text string")
    before = used()
    found = index.find_articles(spark.createDataFrame(texts, "doc_id int, title string, body string"), asked, "q")
    assert found.count() == 120
    assert used() - before < 2 * sum(len(t) for _, _, t in texts)
