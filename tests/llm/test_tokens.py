"""Token operators against the tokenizers library itself."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subscope.llm import bpe, encoding, packing, queries, token_counts, token_files

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "B", "'", "s", "'s", "'LL", " ", "  ", "\n", "\t", "\x85", " ", "　", "é", "É", "é", "1", "²", ",",
    "—", "«", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "İ", "K", "ſ", "中", "😀", "\x1c", "\x00", "Σ", "the", "ing", "aaaa",
]


def library(path):
    return Tokenizer.from_file(path)


def ids_of(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("make", [
    lambda: encoding.encoder(WORD_FILE), lambda: encoding.encoder(BYTE_FILE), lambda: bpe.speculator(BYTE_FILE),
])
def test_encoders_agree_with_the_library(make):
    ours = make()

    @settings(max_examples=40, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join) | st.text(max_size=20), max_size=30))
    def check(texts):
        ids, bounds = ours.encode(pa.array(texts, pa.string()))
        theirs = [e.ids for e in ours.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == theirs
        assert ours.counts(pa.array(texts, pa.string())).tolist() == [len(t) for t in theirs]

    check()


def test_half_a_special_token_cuts_nothing_together():
    ours = bpe.speculator(BYTE_FILE)
    texts = ["a <|b\n\nc d", "<|\n\n x", "if a <| b:\n\n\n    go", "<|\n\n<|endoftext|>\n\nx", "plain\n\ntext"]
    ids, bounds = ours.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(BYTE_FILE, t) for t in texts]


@pytest.mark.parametrize("path", [WORD_FILE, BYTE_FILE])
def test_long_texts_with_special_strings_are_cut(path):
    ours = encoding.encoder(path)
    text = "words <| and more\n\n" * 3000 + "<|endoftext|>  \n x<|endoftext|><|endoftext|>" + " 'tis prose,  yes" * 3000
    pieces = ours.chunks(pa.array([text, "", text]))
    assert (pieces.ends - pieces.starts).max() < 40 and len(pieces) > 10_000
    ids, bounds = ours.encode(pa.array([text, "", text]))
    assert ids[: bounds[1]].tolist() == ids[bounds[2] :].tolist() == ids_of(path, text) and bounds[1] == bounds[2]


def test_long_words_are_merged_as_the_library_does():
    ours, rng = bpe.speculator(BYTE_FILE), random.Random(9)
    texts = ["".join(rng.choices("abcdefghijklmnop", k=n)) for n in (63, 64, 65, 66, 500, 30_000)] + ["the" * 9000, "a" * 20_000, "0" * 700]
    ids, bounds = ours.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(BYTE_FILE, t) for t in texts]


def test_speculation_fails_and_is_mended():
    ours, rng = bpe.Speculator(BYTE_FILE), random.Random(5)
    texts = ["".join(rng.choices("abcdeinrst", k=rng.randint(1, 40))) for _ in range(3000)] + ["a" * n for n in range(1, 60)]
    ids, bounds = ours.encode(pa.array(texts))
    theirs = [e.ids for e in ours.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == theirs
    data, ends = ours.decode(ids, bounds)
    assert [bytes(data[a:b]).decode() for a, b in zip(ends, ends[1:])] == texts


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(encoding, "MAX_CHUNKS", 3)
    ours = encoding.Encoder(WORD_FILE)
    for text in ("one two three four five", "six seven one two", "one"):
        ids, _ = ours.encode(pa.array([text]))
        assert ids.tolist() == ids_of(WORD_FILE, text)


def test_counts(awkward):
    found = token_counts.token_counts(awkward, WORD_FILE, limit=100).collect()
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), n := len(ids_of(WORD_FILE, r.text)), n > 100)
        for r in awkward.select("doc_id", "text").collect()
    )
    assert sorted((str(r.doc_id), *r[1:]) for r in found) == want
    assert token_counts.token_counts(awkward.limit(0), WORD_FILE).collect() == []


def test_files(spark, awkward, tmp_path):
    stored = token_files.write_tokens(awkward.repartition(5), WORD_FILE, str(tmp_path / "t"), length=8, rows=4)
    found = stored.documents(spark).orderBy("start").collect()
    start = 0
    for row in found:
        assert row.start == start
        start += row.n_tokens
    want = sorted((str(r.doc_id), len(i := [*ids_of(WORD_FILE, r.text), 1]), crc(i)) for r in awkward.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda k: (k is not None, k))


def test_a_key_of_many_rows_fills_many_files(spark, tmp_path):
    rows = [(7 if i % 3 == 0 else i, "same text" if i % 6 == 0 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    stored = token_files.write_tokens(df, WORD_FILE, str(tmp_path / "t"))
    sizes = [r["n_docs"] for r in stored.manifest(spark).collect()]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 3000 and max(sizes) < 600
    found = stored.documents(spark).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(k for k, _ in rows)
    assert "://" in token_files.qualified(spark, "/x") or token_files.qualified(spark, "/x").startswith("file:")


def test_sequences_are_read_in_place(spark, docs, tmp_path):
    one = docs.orderBy("doc_id").limit(20).coalesce(1)
    stored = token_files.write_tokens(one, WORD_FILE, str(tmp_path / "t"), length=16, rows=8)
    files = stored.manifest(spark).orderBy("part").collect()
    held = token_files.SequenceFile(files[0]["file"])
    ids, mask = held.sequence(3)
    assert len(ids) == len(mask) == 16 and not ids.flags.owndata and all(mask.to_pylist())
    n = files[0]["n_tokens"]
    last, mask = held.sequence((n - 1) // 16)
    assert sum(mask.to_pylist()) == (n - 1) % 16 + 1
    assert token_files.write_tokens(one.limit(0), WORD_FILE, str(tmp_path / "e")).documents(spark).collect() == []


def test_round_trip(awkward):
    found = bpe.round_trip(bpe.encode_decode(awkward, BYTE_FILE)).collect()
    tokenizer, want = library(BYTE_FILE), []
    for r in awkward.select("doc_id", "text").collect():
        ids = ids_of(BYTE_FILE, r.text)
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((str(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), *r[1:]) for r in found) == sorted(want)


def check_packing(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packing(spark, awkward, small):
    rows = queries.packed(awkward).collect()
    check_packing(rows, packing.CAPACITY)
    want = []
    for r in awkward.select("doc_id", "text").collect():
        ids = [*ids_of(WORD_FILE, r.text), 1]
        want += [(str(r.doc_id), i // 4096, i, len(p := ids[i : i + 4096]), crc(p)) for i in range(0, len(ids), 4096)]
    assert sorted((str(r[0]), *r[1:5]) for r in rows) == sorted(want)
    assert queries.packed(awkward.limit(0)).collect() == []
    whole = queries.op2_packing(spark, small).collect()
    assert check_packing(whole, 4096) == -(-sum(r["length"] for r in whole) // 4096)


def test_exchange_saves_sequences(spark, monkeypatch):
    lengths = np.random.default_rng(1).integers(1, 700, 3000).tolist()
    pieces = spark.createDataFrame(list(enumerate(lengths)), "row long, length long").repartition(4)
    rounds, pack = [], packing._packed

    def watched(rows, n, stage, capacity):
        made = pack(rows, n, stage, capacity)
        rounds.append((rows, made))
        return made

    monkeypatch.setattr(packing, "_packed", watched)
    found = packing.pack(pieces, capacity=1000, per_partition=100).join(pieces, "row").collect()
    apart = {r.row: r for r in rounds[0][1].collect()}
    parts = {}
    for r in apart.values():
        parts.setdefault(r.sequence_id >> 32, []).append(r)
    for rows in parts.values():  # a certificate says that no packing of the partition needs fewer
        bound = packing.lower_bound(*np.unique([r.length for r in rows], return_counts=True), 1000)
        assert {r.certified for r in rows} == {sum(r.opens for r in rows) == bound}
    gaps = {r.row for r in apart.values() if not r.certified and r.spare > 0}
    assert gaps and {r.row for r in rounds[1][0].collect()} == gaps  # those exchange, and nothing else
    least = packing.lower_bound(*np.unique(lengths, return_counts=True), 1000)
    assert least <= check_packing(found, 1000) < sum(r.opens for r in apart.values()) and len(found) == 3000


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, _ = packing.best_fit_decreasing(lengths, 100)
        assert packing.lower_bound(*np.unique(lengths, return_counts=True), 100) <= bins.max() + 1
    assert packing.lower_bound(np.array([51]), np.array([7]), 100) == 7


def test_lengths_out_of_bounds_are_refused(spark):
    for length in (0, 4097, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, length)], "row long, length long"))
