import re
import string

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

LONG = "prose of some length goes on and on " * 3000
BASE = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t", None, "a"), (3, "Two words", "en", None),
    (4, "two  WORDS", "fr", "a"), (5, LONG, "en", "a"), (6, LONG, "en", "a"), (7, BASE, "en", "b"),
    (8, BASE.replace("word60", "other"), "en", "b"), (9, BASE, "en", "b"), (10, BASE.upper(), "en", "b"),
    (11, "Déjà vu — «ça» d'été, 12³ <|endoftext|> l'œuvre  x", "fr", "a"), (12, "42 !!", "en", "a"),
    (13, "same line here\nsame line here\nanother line of text\n\nsame  LINE here", "en", "a"),
    (14, "x" * 70_000, "en", "a"), (None, "a row without a key", "en", "a"),
    (7, BASE, "en", "b"), (15, "日本語のテキスト 😀 Σίσυφος İstanbul", "xx", "a"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, blanks, long texts, copies, repeated rows and columns named like the operators' own."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for name in ("key", "row", "who", "place", "bucket", "node", "block", "word", "hash", "ids", "kept", "part"):
        df = df.selectExpr("*", f"doc_id as {name}")
    return df


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


class Groups:
    """Union-find in memory."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def similar_pairs(sets, percent):
    """All pairs of indices whose sets are similar, by an inverted list."""
    shared, having = {}, {}
    for i, one in enumerate(sets):
        for item in one:
            for j in having.setdefault(item, []):
                shared[j, i] = shared.get((j, i), 0) + 1
            having[item].append(i)
    return [
        p for p, n in shared.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)
    ]
