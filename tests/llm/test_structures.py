"""Benchmark windows, the trie of conversations and hard negatives, each against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from subscope.llm import decontamination, hard_negatives, prefix_trie
from tests.compare import connect, differences
from tests.llm.conftest import LOWER

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_prefix_trie", "op13_hard_negatives"])
def test_against_sql(spark, small, name):
    assert differences(spark, connect(small), name, small) == []


# --- benchmark windows ---

PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a strange potion"
ITEMS = [
    (1, PASSAGE), (2, "Seven Wizards"), (3, None), (4, " -- "), (1, "seven, wizards!"), (None, "strange potion"),
    (5, "seven wizards"), (6, "a a a a a a a a a a a a"), (7, "été œuvre 42"), (8, PASSAGE + " and more"), (9, "x"),
]


def wanted(texts, items, window, shingle, percent):
    needles = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            needles[tuple(w[i : i + window])].add(item)
    out = []
    for text in texts:
        w, hit, found = item_words(text), set(), set()
        for needle, own in needles.items():
            n = len(needle)
            size = min(n, shingle)
            runs = {needle[i : i + size] for i in range(n - size + 1)}
            for i in range(len(w) - n + 1):
                here = tuple(w[i : i + n])
                shared = len(runs & {here[j : j + size] for j in range(n - size + 1)})
                if here == needle if percent == 100 else 100 * shared >= percent * len(runs):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("window, shingle, percent", [(10, 5, 100), (6, 3, 100), (10, 3, 75), (4, 1, 50)])
def test_windows(spark, awkward, window, shingle, percent):
    texts = [
        PASSAGE, PASSAGE.upper().replace(" ", " -- "), PASSAGE.replace("lazy", "busy"), "so " + PASSAGE[20:70] + " end", None, "",
        "seven", "seven wizards seven wizards", "a " * 50, "Été œuvre 42 x", (PASSAGE + " filler words ") * 40, PASSAGE, "potion strange potion",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = df.unionByName(awkward.select("doc_id", "text")).withColumn("needle", F.lit(1)).withColumn("shingle", F.lit("x"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("item", F.lit(0))
    found = decontamination.contamination(df, items, window=window, shingle=shingle, percent=percent).collect()
    rows = df.select("doc_id", "text").collect()
    want = wanted([r.text for r in rows], ITEMS, window, shingle, percent)
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found))) == sorted(
        map(str, ((r.doc_id, *w) for r, w in zip(rows, want)))
    )


def test_windows_of_empty_tables(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    assert decontamination.contamination(docs.limit(9), items.limit(0)).where("n_hit > 0 or size(items) > 0").count() == 0


def test_documents_without_hits(spark):
    df = spark.createDataFrame([(1, PASSAGE), (2, "clean"), (None, "clean"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    assert {r.doc_id for r in decontamination.without_hits(df, items).collect()} == {2, 3, None}


# --- the trie ---


def trie_rows(rows):
    """The contract's rows for conversations ``conv_id, turn, role, text``."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), role, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), text))
    turns = {c: [(r, t) for _, r, _, t in sorted(x, key=lambda y: y[:3])] for c, x in convs.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        built[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    nodes = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[built[c][:d]].append(c)
    children = defaultdict(int)
    for n in nodes:
        if n:
            children[n[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, members in nodes.items():
        own = (len(members) - 1) * len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += own
    out = []
    for n, members in nodes.items():
        ends = ",".join(str(c) for c in members if len(built[c]) == len(n))
        out.append((
            members[0], len(n), min(nodes[n[:-1]]) if n else None, len(members), children[n], leaves[n], saved[n],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def op12(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("seq", "at", "depth", "name", "block", "part", "place", "weight", "digest"):
        df = df.withColumn(name, F.lit(7))
    df.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return [tuple(r) for r in driver.queries()["op12_prefix_trie"](spark, str(tmp_path)).collect()]


def test_trie(spark, tmp_path):
    draw = random.Random(3)
    rows = [(None, 1, "user", "nobody's"), (3, None, None, None), (3, None, None, None), (3, 1, "user", "tie"), (3, 1, "user", "also"),
            (3, 1, "system", "tie"), (-7, 0, "user", "negative"), (-5, 0, "user", "below"), (10, 0, "user", "été"), (10, 1, "user", "")]
    for c in range(20, 80):
        for t in range(draw.randint(1, 13)):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", "ccc"])))
    rows += [(90, t % 700, "user", "same") for t in range(900)]  # a long one, every turn up to 200 twice
    rows += [(91, 0, "user", "x" * 100_000)]
    assert sorted(map(str, op12(spark, tmp_path, rows))) == sorted(map(str, trie_rows(rows)))


def test_trie_of_no_rows(spark, tmp_path):
    assert op12(spark, tmp_path, [(None, 1, "user", "x")]) == []
    assert len(op12(spark, tmp_path, [(1, 1, "user", "x")])) in (1, 2)


def test_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 7)
    ends = spark.range(-20, 1000).select((F.col("id") % 3 == 0).cast("string").cast("binary").alias("name"), F.col("id").alias("seq"))
    found = {bytes(r.name): r.ends_sha256 for r in prefix_trie.ends_digest(ends).collect()}
    for name in (True, False):
        ids = ",".join(str(i) for i in range(-20, 1000) if (math.fmod(i, 3) == 0) == name)
        assert found[str(name).lower().encode()] == hashlib.sha256(ids.encode()).hexdigest()


# --- hard negatives ---


def negatives(rows, positives=5, count=3):
    held = [
        (i, k, label, [math.floor(256 * x) for x in v]) for i, (k, v, label) in enumerate(rows)
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = []
    for i, k, label, v in held:
        if k is None or k % 50:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), key, j, own) for j, key, own, w in held if j != i]
        for positive in sorted((s for s in scores if s[3] == label), key=order)[:positives]:
            p = positive[0]
            found = sorted((s for s in scores if s[3] != label and 50 * p <= 100 * s[0] <= 95 * p), key=order)[:count]
            out += [(k, positive[1], rank, s[1], p, s[0]) for rank, s in enumerate(found, 1)]
    return out


@pytest.mark.parametrize("layout", [{}, {"cell_rows": 40, "block_rows": 25}])
def test_hard_negatives(spark, layout):
    draw = random.Random(8)
    as_float = lambda v: [x if x is None else float(F_(x)) for x in v]
    import numpy as np

    F_ = np.float32
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = []
    for i in range(420):
        c = draw.choice(centres)
        rows.append((i, as_float([x + draw.gauss(0, 0.3) for x in c]), draw.randrange(4)))
    same = as_float([1.0, 0.5, -0.25, 0.0, 2.0, 1.5])
    rows += [(1000 + i, same, i % 2) for i in range(150)]  # copies, anchors among them
    rows += [
        (50, as_float([0.1] * 6), None), (100, None, 1), (150, [1.0, None], 1), (200, [float("nan")] * 6, 1), (250, [float("inf")] * 6, 1),
        (300, [], 1), (350, [0.0] * 6, 2), (None, same, 1), (400, [3.0, 1.0], 1), (0, as_float(centres[0]), 1), (0, as_float(centres[0]), 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in ("row", "key", "query", "v", "block", "low", "anchor"):
        df = df.withColumn(name, F.col("vec_id"))
    found = [tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **layout).collect()]
    assert sorted(map(str, found)) == sorted(map(str, negatives(rows)))


def test_hard_negatives_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [0.0], 1), (50, [0.0], 1), (2, [0.0], 2)]):
        found = hard_negatives.mine(spark.createDataFrame(rows, schema), F.col("vec_id") % 50 == 0).collect()
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, negatives(rows)))


def test_a_tree_covers_its_points(spark):
    import numpy as np
    import pyarrow as pa

    draw = np.random.default_rng(4)
    points = np.repeat(draw.integers(-200, 200, (40, 5)), 6, 0) + draw.integers(-9, 9, (240, 5))
    n = len(points)
    nodes = hard_negatives._grown(pa.table({
        "block": np.zeros(n, np.int32), "row": np.arange(n), "key": np.arange(n), "label": np.zeros(n, np.int32),
        "v": pa.array(points.tolist(), pa.list_(pa.int32())),
    })).to_pandas()
    assert sorted(nodes.place[nodes.fresh]) == list(range(n))
    length = np.sqrt((points**2).sum(1))
    lifted = np.concatenate([points, np.sqrt(length.max() ** 2 - length**2)[:, None]], 1) / length.max()
    for i in range(len(nodes)):
        at = i
        while at >= 0:  # every node above covers this one's centre
            away = np.arccos(np.clip(lifted[nodes.place[i]] @ lifted[nodes.place[at]], -1, 1))
            assert away <= nodes.radius[at] + 1e-6
            at = nodes.parent[at]
