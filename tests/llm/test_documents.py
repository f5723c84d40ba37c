"""Document and line operators against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from subscope.functions import bitmaps
from subscope.llm import components, exact_dedup, language_id, line_dedup, linking, lm_scoring, meeting, near_dedup, quality_rules
from subscope.llm.spans import texts_of
from tests.llm.conftest import WORD, Groups, similar_pairs, words_of


def by_key(rows):
    return sorted((str(r[0]), *r[1:]) for r in rows)


def shingle_set(text, n):
    words = words_of(text)
    return frozenset(zip(*(words[i:] for i in range(n)))) if len(words) >= n else frozenset([tuple(words)] if words else [])


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates(awkward, docs, n):
    unique = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    for df in (unique, docs):
        rows = df.select("doc_id", "text").collect()
        sets = [shingle_set(r.text, n) for r in rows]
        groups = Groups([r.doc_id for r in rows])
        for i, j in similar_pairs(sets, 80):
            groups.link(rows[i].doc_id, rows[j].doc_id)
        want = [(str(r.doc_id), len(s), c := groups.find(r.doc_id), c == r.doc_id) for r, s in zip(rows, sets)]
        assert by_key(near_dedup.near_duplicates(df, n=n).collect()) == sorted(want)


def test_near_duplicates_of_awkward_rows(awkward):
    found = near_dedup.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    assert {r.component_id for r in found if r.doc_id == 7} == {7}
    assert near_dedup.near_duplicates(awkward.limit(0)).collect() == []


def test_one_group_of_many(spark):
    """Each is like its neighbours only, so no one of a bucket is like all of them."""
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 60))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_duplicates(df, n=4).collect()
    assert {r.component_id for r in found} == {0}


def test_sketches_let_true_pairs_through():
    shape, rng = near_dedup.SHAPE, np.random.default_rng(2)
    apart = []
    for _ in range(60):
        both = rng.integers(0, 2**64, 400, np.uint64)
        a, b = both[:360], both[40:]  # similarity 0.8
        _, sketch = shape.signatures(np.concatenate([a, b]), np.array([0, 360, 720]))
        apart.append(sum(int(x).bit_count() for x in sketch[0] ^ sketch[1]))
    assert max(apart) <= shape.most_bits_apart(80)
    assert shape.missed(80) < 1e-6
    far = [sum(int(x).bit_count() for x in np.bitwise_xor(*shape.signatures(rng.integers(0, 2**64, 800, np.uint64), np.array([0, 400, 800]))[1])) for _ in range(20)]
    assert min(far) > shape.most_bits_apart(80)


def test_small_sets_meet_as_often_as_large_ones():
    shape, rng, n = line_dedup.SHAPE, np.random.default_rng(11), 20_000
    for total in (5, 10, 15, 40):
        sets = rng.integers(0, 2**64, (n, total), np.uint64)
        parts = [shape.signatures(x.ravel(), np.arange(n + 1) * x.shape[1])[0] for x in (sets, sets[:, : total * 4 // 5])]
        missed = (~(parts[0] == parts[1]).any(1)).sum()
        assert missed <= 5 * n * shape.missed(80)


def test_whole_sketches_reject_no_similar_pair():
    shape, rng = near_dedup.SHAPE, np.random.default_rng(5)
    for n in (10, 90, 900, 9000):
        both = rng.integers(0, 2**64, n, np.uint64)
        own = n // 10  # the sets share 80 percent of all
        a, b = shape.parities(np.concatenate([both[:-own], both[own:]]), np.array([0, n - own, 2 * (n - own)]))
        assert 180 * sum(int(x).bit_count() for x in a ^ b) <= 20 * 2 * (n - own)


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200), (150, 200), (300, 150)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100, 300: 100}


def test_bitmap_lets_all_keys_through(spark):
    keys = spark.range(0, 60_000, 3)
    found = bitmaps.maybe_in(spark.range(60_000), keys, "id")
    assert found.join(keys, "id").count() == 20_000 and found.count() < 21_000


def test_exact_duplicates(awkward, monkeypatch):
    rows = awkward.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.text or "", []).append(r.doc_id)
    for keep, best in (("smallest", min), ("largest", max)):
        want = sorted(
            (str(r.doc_id), k := best((i for i in g if i is not None), default=None), len(g), r.doc_id == k, hashlib.sha256((r.text or "").encode()).hexdigest())
            for r in rows if (g := groups[r.text or ""])
        )
        assert by_key(exact_dedup.exact_duplicates(awkward, keep=keep).collect()) == want
    # a hash that says nothing: the bytes alone tell the texts apart
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: exact_dedup.F.lit("00" * 16))
    assert by_key(exact_dedup.exact_duplicates(awkward, keep="largest").collect()) == want
    assert exact_dedup.exact_duplicates(awkward.limit(0)).collect() == []


def counts_of(text):
    text = text or ""
    words, seen, n_dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            n_dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), n_dup, len(covered)


def test_quality_counts(awkward, docs):
    for df in (awkward, docs):
        found = quality_rules.judge(df).collect()
        want = [(str(r.doc_id), *counts_of(r.text)) for r in df.select("doc_id", "text").collect()]
        assert sorted((str(r[0]), *r[1:6]) for r in found) == sorted(want)
        assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in found)
    assert quality_rules.judge(awkward.limit(0)).collect() == []


def test_boilerplate(spark):
    def body(i, n):
        return " ".join(f"w{i}_{j}" for j in range(n))

    menu = ["Home  About", "All rights RESERVED"]
    own = ["\n".join(body(f"{i}_{k}", 4) for k in range(30)) for i in range(60)]
    rows = [(i, "\n".join([menu[0], own[i], menu[1].lower()]), "a") for i in range(60)]  # boilerplate goes
    rows += [(100 + i, "\n".join([body("s", 60), body("t", 60), "edit"]), "a") for i in range(40)]  # copies count once
    rows += [(200 + i, "\n".join([body(f"m{k}", 30) for k in range(4)] + [f"{i} end"]), "b") for i in range(3)]
    nav = [body(f"n{k}", 60) for k in range(3)]
    rows += [(300 + i, "\n".join([*nav, body(f"x{i}", 8)]), "c") for i in range(2)]
    rows += [(400 + i, "\n".join([nav[i % 3], *(body(f"y{i}_{k}", 8) for k in range(30))]), "c") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "length(text) as n_chars")
    kept = {r.doc_id: r for r in quality_rules.clean(df).collect()}
    assert {i for i, *_ in rows} - set(kept) == {300, 301}
    template = [f"{body(f'template{k}', 9)} line" for k in range(12)]
    pages = [(i, "\n".join([*template, body(f"own{i}", 8)]), "d") for i in range(60)]
    found = quality_rules.judge(spark.createDataFrame(pages, "doc_id long, text string, source string")).collect()
    assert len(found) == 60 and not any(r.kept or r.base_failed for r in found) and all(r.n_left == 8 for r in found)
    assert all(kept[i].text == own[i] and kept[i].n_chars == len(own[i]) for i in range(60))
    assert all(kept[i].text == t for i, t, _ in rows if 100 <= i < 300)


def verdicts(rows):
    """``kept`` of each ``text, host``, by counting."""
    def lines(text):
        return [tuple(words_of(x)) for x in (text or "").split("\n") if words_of(x)]

    having = {}
    for text, host in rows:
        for line in set(lines(text)):
            having.setdefault((host, line), set()).add(frozenset(lines(text)))
    kept = []
    for text, host in rows:
        n_words, *_, n_repeat = counts_of(text)
        left = sum(len(x) for x in lines(text) if len(having[host, x]) <= 20)
        kept.append(n_words >= 50 and 2 * n_repeat <= n_words and left >= 0.2 * n_words)
    return kept


def test_quality_verdicts(awkward, docs):
    for df in (awkward, docs):
        rows = df.select("doc_id", "text", "source").collect()
        want = [(str(r.doc_id), k) for r, k in zip(rows, verdicts([(r.text, r.source) for r in rows]))]
        assert sorted((str(r.doc_id), r.kept) for r in quality_rules.judge(df).collect()) == sorted(want)


def test_cleaning_leaves_other_columns(awkward):
    before = {str(r.doc_id): r for r in awkward.collect()}
    after = quality_rules.clean(awkward.withColumnRenamed("who", "_who").withColumn("_maybe", F.lit("x")))
    assert after.columns == [*("_who" if c == "who" else c for c in awkward.columns), "_maybe"]
    for r in after.collect():
        assert r.text == before[str(r.doc_id)].text and r._who == r.doc_id and r._maybe == "x"


def test_boilerplate_goes_however_many_lines_there_are(spark):
    def pages(host, first, k, u):
        menu = [f"{host} template line number {i} of all pages here" for i in range(k)]
        return [(first + i, "\n".join([*menu, *(" ".join(f"p{first + i}_{j}_{w}" for w in range(8)) for j in range(u))]), host) for i in range(200)]

    rows = [r for n, (k, u) in enumerate([(2, 1), (3, 1), (5, 5), (10, 5), (10, 20)]) for r in pages(f"h{n}", 1000 * n, k, u)]
    found = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = {n: k for n, k in enumerate([2, 3, 5, 10, 10])}
    assert all(len(r.boilerplate or []) == want[r.doc_id // 1000] for r in found)


def test_language(docs):
    held_out = "crc32(cast(doc_id as string)) % 4 = 2"
    net = language_id.learn(docs.where(f"not ({held_out})"))
    found = language_id.predict(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where(held_out).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_sample_is_bounded_and_of_all_languages(spark, monkeypatch):
    rows = [("the same text", "en")] * 3000 + [(f"text number {i}", "en") for i in range(50)] + [("un texte", "fr")] * 500
    df = spark.createDataFrame(rows, "text string, lang string")
    drawn = {}
    monkeypatch.setattr(language_id, "train", lambda texts, langs, how: drawn.update(texts=texts, langs=langs))
    language_id.learn(df, how=language_id.Training(sample=20))
    assert Counter(drawn["langs"]) == {"en": 10, "fr": 1} and len(set(drawn["texts"])) == 11


def test_language_of_awkward_rows(awkward):
    how = language_id.Training(steps=3, hidden=4)
    found = language_id.predict(awkward, language_id.learn(awkward, how=how)).collect()
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {0, 1, 2, 12}
    assert {r.lang_pred for r in found} <= {"en", "fr", "xx", "und"}
    nothing = language_id.learn(awkward.limit(0), how=how)
    assert {r.lang_pred for r in language_id.predict(awkward, nothing).collect()} == {"und"}


def test_gradients():
    rng = np.random.default_rng(0)
    net = language_id.Network.random(["a", "b", "c"], 4, rng)
    for name in ("table", "state", "out"):
        setattr(net, name, [w.astype(float) for w in getattr(net, name)])
    net.bias = net.bias.astype(float)
    data, label = rng.integers(0, 256, (5, 6)).astype(np.uint8), rng.integers(0, 3, 6)
    _, grads = language_id.gradients(net, data, label)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        value, sides = p[at], []
        for step in (1e-3, -1e-3):
            p[at] = value + step
            sides.append(language_id.gradients(net, data, label)[0])
        p[at] = value
        assert g[at] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=1e-3)


def test_reading_is_the_same_however_texts_meet():
    import pyarrow as pa

    net = language_id.Network.random(["a", "b"], 8, np.random.default_rng(1))
    texts = ["x" * n for n in (0, 1, 127, 128, 129, 1000)] + ["some text of words"]
    together = language_id.pooled(net, texts_of(pa.array(texts)))
    alone = np.concatenate([language_id.pooled(net, texts_of(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)


def test_line_duplicates(awkward, docs):
    unique = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    for df in (unique, docs):
        lines = {}
        for r in sorted(df.select("doc_id", "text").collect()):
            for i, line in enumerate((r.text or "").split("\n")):
                if words_of(line):
                    lines[r.doc_id, i] = " ".join(words_of(line))
        first = {}
        for place, line in lines.items():
            first.setdefault(line, place)
        distinct = list(first)
        sets = [frozenset(t[i : i + 8] for i in range(len(t) - 7)) or frozenset([t]) for t in distinct]
        groups = Groups(first.values())
        for i, j in similar_pairs(sets, 80):
            groups.link(first[distinct[i]], first[distinct[j]])
        want = sorted((*p, *(k := groups.find(first[t])), k == p) for p, t in lines.items())
        assert sorted(map(tuple, line_dedup.duplicate_lines(df).collect())) == want
        kept = {(a, b) for a, b, *_, keep in want if keep}
        for r in line_dedup.keep_lines(df).select("doc_id", "text").collect():
            assert r.text is None or sum(bool(words_of(x)) for x in r.text.split("\n")) == sum(a == r.doc_id for a, _ in kept)
    assert line_dedup.duplicate_lines(awkward.limit(0)).collect() == []
    assert line_dedup.duplicate_lines(awkward).count() > 0


def test_lines_like_their_neighbours_only(spark, monkeypatch):
    """A large bucket's lines are connected in one go, with as many tables written as for any other."""
    written = []
    real = line_dedup.stored
    for module in (line_dedup, linking, meeting):
        monkeypatch.setattr(module, "stored", lambda df: written.append(df) or real(df), raising=False)
    text = "".join(chr(97 + int(x)) for x in np.random.default_rng(3).integers(0, 26, 700))
    chain = [(i, text[i * 4 : i * 4 + 300]) for i in range(90)]
    other = [(200 + i, f"{text[400:]} {'yz'[i % 2]}{i}") for i in range(60)]
    short = [(300, "a b"), (301, "A  b"), (302, "a c")]
    df = spark.createDataFrame([*chain, *other, *short], "doc_id long, text string")
    found = {r.doc_id: (r.keep_doc_id, r.kept) for r in line_dedup.duplicate_lines(df).collect()}
    want = {i: 0 for i, _ in chain} | {i: 200 for i, _ in other} | {300: 300, 301: 300, 302: 302}
    assert found == {i: (k, i == k) for i, k in want.items()}
    assert len(written) <= 10


def test_lines_of_a_large_bucket_are_cut_once(monkeypatch):
    """However often a line is compared with others: cutting it into shingles again each time was most of the work."""
    text = "".join(chr(97 + int(x)) for x in np.random.default_rng(4).integers(0, 26, 1500))
    lines = [text[i * 4 : i * 4 + 300] for i in range(200)] + [f"{text[1200:]} {'yz'[i % 2]}{i}" for i in range(50)]
    sets = line_dedup._sets(texts_of(pa.array(lines)))
    parity = line_dedup.lists(line_dedup.SHAPE.parities(*sets), np.ones(len(lines), bool))
    n, cut, real = len(lines), [], line_dedup.mixed
    rows = pa.table({
        "run": np.zeros(n, np.int64), "node": np.arange(n), "side": np.zeros(n, np.int32), "size": np.diff(sets[1]),
        "parity": parity, "body": lines,
    })
    monkeypatch.setattr(line_dedup, "mixed", lambda x: cut.append(len(x)) or real(x))
    found = meeting._connected(rows, 80, lambda body: line_dedup._comparer(body, 80))
    groups = Groups(range(n))
    for a, b in zip(found["a"].to_pylist(), found["b"].to_pylist()):
        groups.link(a, b)
    assert [groups.find(i) for i in range(n)] == [0] * 200 + [200] * 50
    assert sum(cut) <= sum(map(len, lines))


@pytest.mark.parametrize("sides", [1, 2])
def test_lines_of_a_large_bucket_are_sifted(monkeypatch, sides):
    """Whole sketches are compared only where sizes and the first words of them allow it, not for all pairs, and nothing is missed."""
    draw = np.random.default_rng(5)
    lines = ["".join(chr(97 + int(x)) for x in draw.integers(0, 26, n)) for n in draw.integers(20, 300, 400)]
    lines += [f"{line} {i % 7}" for i, line in enumerate(lines[:40])]
    sets = line_dedup._sets(texts_of(pa.array(lines)))
    n, compared, real = len(lines), [], meeting._maybe
    rows = pa.table({
        "run": np.zeros(n, np.int64), "node": np.arange(n), "side": np.arange(n) // 400 if sides == 2 else np.zeros(n, np.int64),
        "size": np.diff(sets[1]), "parity": meeting.packed(line_dedup.SHAPE.parities(*sets), np.ones(n, bool)), "body": lines,
    })
    monkeypatch.setattr(meeting, "_maybe", lambda size, parity, a, b, percent: compared.append(len(b)) or real(size, parity, a, b, percent))
    found = meeting._connected(rows, 80, lambda body: line_dedup._comparer(body, 80))
    whole = [frozenset(t[i : i + 8] for i in range(len(t) - 7)) for t in lines]
    want = {i for i in range(40) if 100 * len(whole[i] & whole[400 + i]) >= 80 * len(whole[i] | whole[400 + i])}
    assert len(want) > 30 and {tuple(sorted(x)) for x in zip(found["a"].to_pylist(), found["b"].to_pylist())} == {(i, 400 + i) for i in want}
    assert sum(compared) < n * (n - 1) / 2 / 20


def test_lines_are_compared_by_all_their_shingles(monkeypatch):
    """Whatever parts and blocks they are cut in, of whatever characters they are, long and short."""
    draw = np.random.default_rng(6)
    lines = ["a", "ab", "a b c d", "é", "ab", "日本語", "a" * 50, "ab" * 30, "ab" * 31]
    for letters in ("abc", "aé日😀", "xy"):
        base = "".join(draw.choice(list(letters), 120))
        lines += [base[i : i + 40 + 5 * (i % 3)] for i in range(0, 60, 4)]
    sets = [frozenset(t[i : i + 8] for i in range(len(t) - 7)) or frozenset([t]) for t in lines]
    monkeypatch.setattr(line_dedup, "PART_BYTES", 64)
    monkeypatch.setattr(line_dedup, "BATCH_BYTES", 500)
    held, bounds = line_dedup._sets(texts_of(pa.array(lines)))
    assert np.diff(bounds).tolist() == [len(s) for s in sets]
    alike = line_dedup._comparer(pa.array(lines), 80)
    for i, one in enumerate(sets):
        want = [100 * len(one & s) >= 80 * len(one | s) for s in sets]
        assert alike(i, np.arange(len(lines))).tolist() == want
        assert line_dedup._similar((held, bounds), np.full(len(lines), i), np.arange(len(lines)), 80).tolist() == want


def test_blocks_of_a_bucket_all_meet(spark):
    nodes = [(i, [5, 100 + i % 3]) for i in [*range(20), 3, 4]]
    nodes += [(50, [9, 10]), (51, [9, 10]), (52, [11, 12])]
    signed = spark.createDataFrame(nodes, "node long, bands array<long>")
    rows = meeting.runs(signed, 2, per_part=7, block=4).collect()
    met = {}
    for r in rows:
        met.setdefault(r.run, []).append((r.node, r.side))
    pairs = Counter()
    for run in met.values():
        sides = {side for _, side in run}
        pairs.update({(a, b) for a, s in run for b, t in run if a < b and (len(sides) == 1 or s != t)})
    assert set(pairs) == {(a, b) for a in range(20) for b in range(a + 1, 20)} | {(50, 51)}
    assert pairs[50, 51] == 1 and {r.n for r in rows if r.node in (50, 51)} == {2}
    assert not any(r.node == 52 for r in rows)


def test_scores(docs):
    texts = {r.doc_id: [*words_of(r.text), None] for r in docs.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in texts}
    counts = Counter(t for k, ts in texts.items() if not held[k] for t in ts)
    n, v = sum(counts.values()), len(counts)
    found = lm_scoring.score(docs, "crc32(cast(doc_id as string)) % 5 = 1").collect()
    assert len(found) == len(texts)
    for r in found:
        ts = texts[r.doc_id]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ts), sum(counts[t] > 0 for t in ts), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # what was not learnt is told better by pairs


def test_scores_lie_where_exact_counts_put_them(docs, monkeypatch):
    """Kept counts are within a factor of the true ones, so each token's probability is too; chance hits are rare."""
    model = lm_scoring.Model(bits_per_gram=40)
    texts = {r.doc_id: ["", *words_of(r.text), ""] for r in docs.collect()}
    taught = [t for k, t in texts.items() if k % 5 != 1]
    one = Counter(w for t in taught for w in t[1:])
    two = Counter(p for t in taught for p in zip(t, t[1:]))
    n = sum(one.values())
    near = lambda c: float(model.count(model.level(np.array([c])))[0]) if c else 0.0
    about = n + 0.5 * (len(one) + 1)

    def score(words, of):
        total = 0.0
        for a, b in zip(words, words[1:]):
            behind = of(one[a])
            total += math.log10((min(of(two[a, b]), behind) + model.weight * (of(one[b]) + 0.5) / about) / (behind + model.weight))
        return total

    results = []
    for grams in (1 << 20, 1 << 14):  # few segments and many
        monkeypatch.setattr(lm_scoring, "SEGMENT_GRAMS", grams)
        found = {r.doc_id: r.score for r in lm_scoring.score(docs, "doc_id % 5 = 1", model=model).collect()}
        results.append(found)
        off = np.array([abs(found[k] - score(t, near)) / len(t) for k, t in texts.items()])
        assert np.median(off) < 0.01 and off.max() < 0.2  # V is estimated, and a few n-grams are taken for others
        exact = np.array([abs(found[k] - score(t, float)) / len(t) for k, t in texts.items()])
        assert exact.max() < 2 * math.log10(model.base) + 0.2
    assert np.allclose(list(results[0].values()), list(results[1].values()), rtol=0.02)


def test_bits_and_segments_grow_with_the_training_text():
    model = lm_scoring.Model()
    for n in (1, 10**7, 10**8, 10**10, 10**13):
        segments, bits = lm_scoring.sizes(n, model)
        assert segments * bits >= model.bits_per_gram * 2 * n and bits <= 2 * model.bits_per_gram * lm_scoring.SEGMENT_GRAMS


def test_scores_of_many_partitions(spark):
    rows = [(i, f"word{i} of text {i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, lm_scoring.score(df.coalesce(1), "doc_id % 5 = 1").collect()))
    found = sorted(map(tuple, lm_scoring.score(df.repartitionByRange(300, "doc_id"), "doc_id % 5 = 1").collect()))
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in want])


def test_filter_counts():
    model, rng = lm_scoring.Model(), np.random.default_rng(4)
    counts = np.concatenate([np.ones(500, np.int64), rng.integers(2, 5000, 500)])
    level = model.level(counts)
    assert (np.abs(np.log(model.count(level) / counts)) <= math.log(model.base)).all()


def test_scores_of_awkward_rows(awkward):
    found = lm_scoring.score(awkward, "false").collect()
    assert len(found) == awkward.count() and all(np.isfinite(r.score) and r.score <= 0 for r in found)
    untaught = lm_scoring.score(awkward, "true").collect()
    assert all(r.train_tokens == r.n_known == 0 and r.score == pytest.approx(0, abs=1e-9) == r.base_score for r in untaught)
    assert lm_scoring.score(awkward.limit(0), "false").collect() == []
