"""Texts longer than what operators handle at once: each against its plain version, beside short ones."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from test_models import base
from tokenizers import Tokenizer

from episodica.llm import langid, pages, quality
from episodica.llm.bpe import byte_bpe, read_ranks
from episodica.llm.counts import token_counts
from episodica.llm.decontam import decontaminate
from episodica.llm.lines import line_dedup
from episodica.llm.orc_ids import checked, read_token_files, write_token_files
from episodica.llm.secrets import scan, secret_scan
from episodica.llm.simhash import near_copies, near_duplicates
from episodica.llm.text import CHUNK_BYTES, chunks

RANKS, SPEC = (public_tokenizers.path(x) for x in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"))
PASSAGE = "these ten words stand at the very end of it"


def _long():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdéfgh") for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    lines = [" ".join(rng.choices(words, k=12)) + f" {i}" for i in range(CHUNK_BYTES // 55)]
    return "\n".join([*lines, f"AKIA{'Q' * 20} {PASSAGE}"])


TEXT = _long()
ROWS = [(1, TEXT), (2, "short"), (3, TEXT + " more"), (4, "x" * (CHUNK_BYTES + 3)), (5, None)]


@pytest.fixture(scope="module")
def docs(spark):
    assert len(TEXT.encode()) > CHUNK_BYTES
    return spark.createDataFrame([(i, t, "en") for i, t in ROWS], "doc_id long, text string, lang string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality(docs):
    got = by_id(quality.quality(docs))
    assert all(tuple(got[i][1:6]) == base(t) for i, t in ROWS)


def test_pages(spark):
    body = "".join(f"<p>paragraph {i} of the page</p>" for i in range(CHUNK_BYTES // 30))
    html = f"<html><nav>menu</nav><article>{body}</article><footer>end</footer></html>"
    df = spark.createDataFrame([(1, "http://a/b", html), (2, "http://a/c", "<p>x</p>")], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
    assert len(html) > CHUNK_BYTES and got[1].split("\n") == [f"paragraph {i} of the page" for i in range(CHUNK_BYTES // 30)]


def test_tokens(spark, docs, tmp_path):
    library, tokenizer = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={}), Tokenizer.from_file(SPEC)
    encoded, counted = by_id(byte_bpe(docs, RANKS)), by_id(token_counts(docs, SPEC))
    write_token_files(docs, SPEC, str(tmp_path / "ids"))
    files = by_id(checked(read_token_files(spark, str(tmp_path / "ids"))))
    for i, t in ROWS[:3]:  # a library takes very long for a single piece of this size
        ids = library.encode_ordinary(t)
        assert (encoded[i]["n_tokens"], encoded[i]["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert encoded[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        assert counted[i]["n_tokens"] == len(ids)
        assert files[i]["ids_crc32"] == zlib.crc32(np.array([*ids, 0], "<u4").tobytes())
    assert encoded[4]["decoded_sha256"] == hashlib.sha256(ROWS[3][1].encode()).hexdigest()


def test_passages_and_secrets(spark, docs):
    got = by_id(decontaminate(docs, spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")))
    assert [got[i]["n_hit"] for i in (1, 2, 3, 4, 5)] == [10, 0, 10, 0, 0]
    got = by_id(secret_scan(docs))
    assert [got[i]["n_access"] for i in (1, 2, 3)] == [1, 0, 1]
    assert all(got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in scan(t)[1]) for i, t in ROWS[:3])


def test_lines(docs):
    got = by_id(line_dedup(docs.where("doc_id <> 4")))
    assert got[3]["text"] == "" or PASSAGE in got[3]["text"]
    assert got[1]["text"].count("\n") > CHUNK_BYTES // 70
    assert by_id(line_dedup(docs.where("doc_id = 4")))[4]["text"] == ROWS[3][1]


def test_copies(docs):
    def plain(text):
        words = text.encode().lower().split()
        bits = np.zeros(64, int)
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
        for g in grams:
            bits += np.unpackbits(np.array([xxhash.xxh64_intdigest(g, 42)], ">u8").view(np.uint8))
        return "".join(f"{b:02x}" for b in np.packbits(2 * bits > len(grams)).tolist())

    got = by_id(near_duplicates(docs))
    assert [got[i]["fingerprint"] for i in (1, 2, 4)] == [plain(ROWS[j][1]) for j in (0, 1, 3)]
    assert got[3]["component_id"] == 1
    assert by_id(near_copies(docs, "doc_id"))[3]["component_id"] == 1


def test_language(spark):
    words = {"de": "der hund und die katze schlafen nicht mehr", "en": "the dog and the cat do not sleep any more"}
    rows = [(i, f"{words[x]} {i}", x) for i in range(80) for x in words]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    long = {x: (w + " ") * (CHUNK_BYTES // len(w) + 9) for x, w in words.items()}
    scored = langid.identify(spark.createDataFrame([(i, t) for i, t in enumerate(long.values())], "doc_id long, text string"), model)
    assert [r["lang_pred"] for r in scored.orderBy("doc_id").collect()] == list(long)
    assert all(len(t) > CHUNK_BYTES for t in long.values()) and len(list(chunks(pa.array([*long.values()])))) == 2
