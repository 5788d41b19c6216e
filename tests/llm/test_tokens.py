"""Operators 3, 6 and 9 against the public libraries; edits and appends; caches; files."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from episodica.llm.bpe import PrefixEncoder, Prefixes, byte_bpe, read_ranks
from episodica.llm.counts import LibraryCounter, read_spec, token_counts
from episodica.llm.orc_ids import checked, read_token_files, write_token_files
from episodica.llm.pieces import PieceCache
from episodica.llm.text import chunks

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SPEC = P.path("byte_bpe_50k.json")
PARTS = ["a", "b", "the", "'s", "'", "'re", "'ll x", "'ve", "n't", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "é", "ß", "1", "½", "!", "...", "日本", "😀", "é", "'S", "<|endoftext|>", "_", "​", "\x00"]
ROWS = [(1, "Hello  world, it's"), (2, None), (3, ""), (4, "x" * 20000), (None, "no id"), (1, "Hello  world, it's"), (5, "<|endoftext|> in 'tis text"), (-7, "ends with spaces   ")]


@pytest.fixture(scope="module")
def encoder():
    return PrefixEncoder(read_ranks(RANKS))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")).withColumn("ids", F.lit(1))


def texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_all_tokens_are_reachable_or_whole(encoder, library):
    for token, rank in list(encoder.ranks.items())[::97]:
        assert encoder.encode(token) == [rank]


@pytest.mark.parametrize("limit", [64, 50_000])
def test_whole_texts_as_the_library(encoder, library, limit):
    cache, all_texts, at = PieceCache(encoder.encode_all), texts(3000), 0
    for c in chunks(pa.array(all_texts), limit):
        ids, bounds = cache.ids(c)
        for i in range(c.rows):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode_ordinary(all_texts[at])
            at += 1
    assert at == len(all_texts)


def test_counts_as_the_library():
    counter, tokenizer, all_texts, at = LibraryCounter(read_spec(SPEC)[1]), Tokenizer.from_file(SPEC), texts(2000), 0
    for c in chunks(pa.array(all_texts), 50_000):
        n, (flat, bounds) = counter.counts(c), counter.ids(c, 0)
        for i in range(c.rows):
            want = tokenizer.encode(all_texts[at], add_special_tokens=False).ids
            assert flat[bounds[i] : bounds[i + 1]].tolist() == [*want, 0] and n[i] == len(want)
            at += 1


def thue_morse(n):
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return [word, word.translate(str.maketrans("ab", "ba"))]


def test_words_that_collide_in_polynomial_hashes(spark, library):
    """Words on which sums of powers modulo 2**64 agree: each text has its own ids, counts, lines and windows."""
    from episodica.llm.decontam import decontaminate
    from episodica.llm.quality import _base

    one, two = thue_morse(11)
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in byte_bpe(df, RANKS).collect()}
    assert all(got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in ((1, one), (2, two), (3, one)))
    counter, tokenizer = LibraryCounter(read_spec(SPEC)[1]), Tokenizer.from_file(SPEC)
    flat, bounds = counter.ids(next(chunks(pa.array([one, two]))), 0)
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [[*tokenizer.encode(t).ids, 0] for t in (one, two)]
    assert _base(next(chunks(pa.array([f"{one}\n{two}", f"{one}\n{one}"]))))[3].tolist() == [0, 1]
    bench = spark.createDataFrame([(1, one)], "item_id long, text string")
    for words in (4_000_000, 0):
        assert {r["doc_id"]: r["contaminated"] for r in decontaminate(df, bench, broadcast_words=words).collect()} == {1: True, 2: False, 3: True}


def test_pieces_that_share_a_hash(monkeypatch, encoder, library):
    """If all pieces had one hash, bytes would still tell them apart."""
    from episodica.llm import pieces
    from episodica.llm.pieces import PieceCache

    monkeypatch.setattr(pieces, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    cache, texts_ = PieceCache(encoder.encode_all), ["alpha beta alpha", "gamma", "beta alpha longerthaneightbytes longerthaneightbytez"]
    ids, bounds = cache.ids(next(chunks(pa.array(texts_))))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [library.encode_ordinary(t) for t in texts_]


def test_files_that_split_otherwise_go_whole(tmp_path):
    """A file with a prefix blank is not split here; its texts go to the library."""
    import json

    spec = json.loads(read_spec(SPEC)[1])
    spec["pre_tokenizer"]["add_prefix_space"] = True
    other, tokenizer = LibraryCounter(json.dumps(spec)), Tokenizer.from_str(json.dumps(spec))
    c = next(chunks(pa.array(["hello there", "", "x y"])))
    assert not other.plain and other.counts(c).tolist() == [len(tokenizer.encode(t).ids) for t in ("hello there", "", "x y")]


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=40))
def test_pieces(encoder, library, piece):
    if piece:
        assert encoder.encode(piece) == library._core_bpe.encode_single_piece(piece)


@settings(max_examples=100, deadline=None)
@given(st.text("theinga rs", max_size=50), st.integers(0, 50), st.integers(0, 8), st.text("thein", max_size=6))
def test_edits_and_appends(encoder, text, start, length, new):
    piece, more = text.encode(), new.encode()
    start = min(start, len(piece))
    end = min(start + length, len(piece))
    state = Prefixes(encoder, piece)
    state.replace(start, end, more)
    fresh = Prefixes(encoder, piece[:start] + more + piece[end:])
    assert state.ids() == fresh.ids() and state.tokens == fresh.tokens
    grown = Prefixes(encoder, piece[:start])
    grown.append(piece[start:])
    assert grown.tokens == Prefixes(encoder, piece).tokens


def test_edit_costs_little(encoder):
    piece = b"abc def" * 2000
    again = Prefixes(encoder, piece).replace(7000, 7001, b"z")
    assert again < 1000


def test_byte_bpe(spark, docs, library):
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe(docs, RANKS).collect()}
    want = set()
    for i, t in ROWS:
        ids = library.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want and byte_bpe(docs, RANKS).count() == len(ROWS)
    assert byte_bpe(docs.limit(0), RANKS, with_ids=True).count() == 0


def test_count_cache(spark, docs, tmp_path):
    path, tokenizer = str(tmp_path / "cache"), Tokenizer.from_file(SPEC)
    want = sorted((str(i), len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    for _ in range(2):
        got = token_counts(docs, SPEC, cache_path=path)
        assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == want
        n = spark.read.parquet(path).count()
        assert n == len({t or "" for _, t in ROWS})  # each content once; nothing is added again
    assert {r["over_limit"] for r in got.where("doc_id = 4").collect()} == {True}
    token_counts(spark.createDataFrame([(9, "new")], "doc_id long, text string"), SPEC, cache_path=path).collect()
    assert spark.read.parquet(path).count() == n + 1
    assert token_counts(docs.limit(0), SPEC).count() == 0


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_only_distinct_misses_are_computed(spark, tmp_path, broadcast):
    """Rows that repeat an id or lack one count once; a second call computes, and returns, no more than it lacks."""
    from episodica.llm.ledger import addressed, bring_up_to_date

    path, seen = str(tmp_path / "ledger"), spark.sparkContext.accumulator(0)

    def compute(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("__digest"), pa.array([len(t) for t in batch.column("__text").to_pylist()])], ["__digest", "size"])

    def call(rows, version):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return bring_up_to_date(df, addressed(df, "doc_id", "text"), "doc_id", "text", version, path, compute, "size long", broadcast).collect()

    rows = [(5, "same text")] * 50 + [(None, "same text")] * 20 + [(None, "none")] * 30 + [(i, f"text {i % 7}") for i in range(40)] + [(1, None), (2, "")]
    assert len(call(rows, "v1")) == 10 and seen.value == 10
    assert len(call(rows[:50] + [(9, "new")], "v1")) == 2 and seen.value == 11
    assert len(call(rows[:50], "v2")) == 1 and seen.value == 12


def test_orc_files(spark, docs, tmp_path):
    path, tokenizer = str(tmp_path / "ids"), Tokenizer.from_file(SPEC)
    write_token_files(docs, SPEC, path)
    got = [tuple(r) for r in checked(read_token_files(spark, path)).orderBy("start").collect()]
    assert [r[0] for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    start, by_id = 0, {}
    for doc, s, n, crc in got:
        assert s == start
        start += n
        by_id.setdefault(doc, set()).add((n, crc))
    for i, t in ROWS:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) in by_id[i]
    assert {r["doc_id"] for r in read_token_files(spark, path, [4]).collect()} == {4}
    write_token_files(docs.limit(0), SPEC, str(tmp_path / "none"))
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0
