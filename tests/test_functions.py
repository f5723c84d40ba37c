import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from subscope.functions.content import flatten_content
from subscope.functions.draws import hash_draw, hash_uniform, padded_key, pick
from subscope.functions.hashing import row_hash
from subscope.functions.scoring import band, round_score
from subscope.schemas import USERS, require
from subscope.settings import RISK_BANDS
from subscope.sources import generate

AS_OF = dt.date(2024, 1, 31)


def test_bands_are_right_closed_on_the_unrounded_score(spark):
    values = [0.0, 0.3, 0.30004, 0.6, 0.60001, 1.0, math.nan, None, -0.02, 1.02]
    rows = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r[0] for r in rows.select(band(F.col("p"), RISK_BANDS)).collect()]
    assert got == ["Baixo", "Baixo", "Médio", "Médio", "Alto", "Alto", "nan", "nan", "nan", "nan"]


def test_scores_round_half_to_even(spark):
    rows = spark.createDataFrame([(0.12345,), (0.12355,), (0.99995,)], "p double")
    assert [r[0] for r in rows.select(round_score(F.col("p"))).collect()] == [0.1234, 0.1236, 1.0]


def test_row_hash_sees_a_value_move_to_a_null_neighbour(spark):
    rows = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    assert rows.select(row_hash(["a", "b"])).distinct().count() == 2


def test_padded_key_keeps_long_numbers(spark):
    rows = spark.createDataFrame([(7,), (12345678,)], "n bigint")
    assert [r[0] for r in rows.select(padded_key(("NBP", 6), "n")).collect()] == ["NBP000007", "NBP12345678"]


@pytest.mark.parametrize("mode", ["murmur3", "md5"])
def test_draws_stay_in_range(spark, mode):
    row = spark.range(20_000).agg(
        F.min(hash_draw("id", "s", mode)), F.min(hash_uniform("id", "s", mode)),
        F.max(hash_uniform("id", "s", mode)), F.avg(hash_uniform("id", "s", mode)),
    ).first()
    assert row[0] >= 0 and 0 <= row[1] and row[2] < 1 and abs(row[3] - 0.5) < 0.02


def test_repeated_items_weigh_more(spark):
    picked = spark.range(20_000).select(pick(["a", "a", "a", "b"], "w", "id").alias("x"))
    share = picked.agg(F.avg((F.col("x") == "a").cast("int"))).first()[0]
    assert 0.73 < share < 0.77


@pytest.mark.parametrize("mode", ["murmur3", "md5"])
def test_generated_tables_do_not_depend_on_partitions(spark, mode):
    def tables(partitions):
        keys = generate.key_range(spark, 300, partitions)
        latent = generate.users_for(keys, 8.0, AS_OF, mode)
        made = (generate.titles_for(keys, mode), generate.gen_users(latent), generate.plays_of(latent, 300, AS_OF, mode))
        return [sorted(map(str, t.collect())) for t in made]

    one = tables(1)
    assert one == tables(4) == tables(16)
    assert len(one[0]) == len(one[1]) == 300 and len(one[2]) > 1000


def test_event_times_do_not_depend_on_the_time_zone(spark):
    latent = generate.gen_users_latent(spark, AS_OF, 20, 200)

    def plays():
        return sorted(map(str, generate.gen_plays(latent, AS_OF, 10).select("event_id", "ts").collect()))

    here = plays()
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert plays() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_generator_edges(spark):
    assert generate.gen_titles(spark, 0).count() == 0
    latent = generate.gen_users_latent(spark, AS_OF, 50, 0)
    assert latent.count() == 50 and generate.gen_plays(latent, AS_OF, 10).count() == 0


def test_generated_keys_resolve_and_kinds_fit(spark):
    titles = generate.gen_titles(spark, 200)
    latent = generate.gen_users_latent(spark, AS_OF, 100, 2000)
    plays = generate.gen_plays(latent, AS_OF, 200)
    assert plays.join(titles, "content_id", "left_anti").count() == 0
    assert plays.join(generate.gen_users(latent), "user_id", "left_anti").count() == 0
    assert titles.where((F.col("kind") == "Série") != F.col("seasons").isNotNull()).count() == 0
    assert titles.where((F.col("kind") == "Filme") != F.col("duration_min").isNotNull()).count() == 0
    assert titles.where(~F.col("synopsis").endswith(F.concat(F.col("genre"), F.lit(".")))).count() == 0
    assert plays.where(~F.col("pct_watched").between(0, 100) | (F.col("watch_min") < 1)).count() == 0
    assert 1500 < plays.count() < 2500


def test_help_articles(spark):
    rows = generate.gen_help(spark).orderBy("position").collect()
    assert len(rows) == 12 and rows[0]["doc_id"] == "AJU-001" and rows[-1]["doc_id"] == "AJU-012"


def test_flatten_content(spark):
    cases = {
        '"oi\\n\\"você\\""': 'oi\n"você"',
        '[{"type":"input_text","text":"a"},{"type":"text","text":""},{"type":"output_text","text":"b"}]': "a\nb",
        '[{"type":"image","url":"x"},{"type":"text","text":"c"}]': "c",
        '[{"type":"image"}]': "",
        "[]": "",
        "null": "",
        "42": "42",
        "plain words": "plain words",
        '["a",5,null,{"type":"text","text":"b"}]': "b",
        '[{"type":"text"},{"type":"text","text":null},{"type":7,"text":"q"},{"type":"text","text":"x"}]': "x",
        '\n [{"type":"text","text":"t"}]': "t",
        '{"a":1}': '{"a":1}',
        "[not a list": "[not a list",
        '"half': '"half',
        "": "",
    }
    rows = spark.createDataFrame(list(cases.items()), "content string, wanted string")
    for row in rows.select("content", "wanted", flatten_content(F.col("content")).alias("got")).collect():
        assert row["got"] == row["wanted"], row["content"]
    missing = spark.createDataFrame([(None,)], "content string")
    assert missing.select(flatten_content(F.col("content"))).first()[0] == ""


def test_require_names_what_is_wrong(spark):
    with pytest.raises(ValueError, match="missing column plan"):
        require(spark.createDataFrame([("U1",)], "user_id string"), USERS, "user_id", "plan")
    with pytest.raises(ValueError, match="plan is int"):
        require(spark.createDataFrame([("U1", 1)], "user_id string, plan int"), USERS, "user_id", "plan")
