"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from mercatura.llm import bpe
from mercatura.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(bpe.vocabulary_path(), "rb") as file:
        return bpe.Vocabulary(file.read())


def texts():
    rng = random.Random(3)
    common = [chr(c) for c in range(0x300)] + list("aeinorst the  \n\t'ABC123<|endoftext|>")
    made = ["".join(rng.choices(common, k=rng.randrange(50))) for _ in range(2000)]
    return made + [
        "",
        "<|endoftext|>",
        "a<|endoftext|><|endoftext|>  b",
        "<|endoftext| >",
        "a" * 5000,
        "=-" * 3000,
        "abc" * 40_000,
        "word " * 30_000,
        "日本語 \U0001f600​ é",
        "it's we'll they've I'd\n\n  x",
    ]


def test_words_equal_the_library(library, vocabulary):
    encoder = bpe.Encoder(vocabulary)
    given = texts()
    for text, packed in zip(given, encoder.encode(given), strict=True):
        ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_any_ids_decode_as_the_library(library, vocabulary):
    rng = random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(12))]
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_small_caches_change_nothing(monkeypatch, library, vocabulary):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    monkeypatch.setattr(bpe, "KEPT_BYTES", 2)
    encoder = bpe.Encoder(vocabulary)
    for text in texts()[:50] * 2:
        (packed,) = encoder.encode([text])
        assert len(packed) // 4 == len(library.encode(text, add_special_tokens=False).ids)


def test_round_trip_keeps_columns_and_nulls(spark, library):
    rows = [(i, t, "kept", [i]) for i, t in enumerate([None, "", *texts()[-6:]])] + [(None, "x y", None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<long>")
    encoded = bpe.encode(table)
    assert encoded.columns == ["doc_id", "text", "decoded", "ids", "ids_"]
    back = bpe.decode(encoded, ids="ids_").collect()
    assert len(back) == len(rows)
    for row in back:
        assert row.decoded_ == (row.text or "")
        assert list(row.ids_) == library.encode(row.text or "", add_special_tokens=False).ids
    assert bpe.encode(table.limit(0)).count() == bpe.digests(table.limit(0)).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op6_bpe"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
