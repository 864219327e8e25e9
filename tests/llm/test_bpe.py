"""Byte-level BPE against the tokenizers library, and a plain merge loop."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import collected
from vaultwright.llm import bpe, queries

PATH = bpe.default_vocabulary()
VOCABULARY = bpe.Vocabulary.load(PATH)
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(VOCABULARY)

ODD = [
    "", " ", "   ", "\n\n a  b\t\tc ", "it's we'll 'S don't I'D", "½ ⅓ ² x\x1cy \x85 \xa0z　w", "<|endoftext|>",
    "a<|endoftext|><|endoftext|> b", "aaaaaaaa" * 700, "né é ß Ünï العربية हिन्दी 中文 🎉👍🏽", "x" * 3000 + "🎉" * 200,
    "퟿\U0010ffff՘a \U000323b0b", "͸ \x00\x00", "1234567 12,345.67 ABC123",
]


def ids_of(text, encoder=ENCODER):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def merged_plainly(symbols):
    """Again and again the leftmost pair of the lowest rank."""
    symbols = list(symbols)
    while True:
        ranked = [(VOCABULARY.merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in VOCABULARY.merges]
        if not ranked:
            return symbols
        _, i = min(ranked)
        symbols[i : i + 2] = [VOCABULARY.merges[symbols[i], symbols[i + 1]][1]]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_equal_the_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids_of(text) == ids
    assert ids_of(text, bpe.Encoder(VOCABULARY, memo_words=1)) == ids
    assert b"".join(VOCABULARY.tokens[i] for i in ids).decode() == text == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text_equals_the_library(text):
    assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinrst hdlo", max_size=60))
def test_queue_equals_the_plain_loop(text):
    symbols = [VOCABULARY.bytes_to_ids[b] for b in text.encode()]
    assert bpe.merge(symbols, VOCABULARY.merges) == merged_plainly(symbols)
    assert symbols == [VOCABULARY.bytes_to_ids[b] for b in text.encode()]


def test_every_character_is_split_as_the_library_does():
    texts = [f"a{c}a1{c}1.{c}. {c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000), *range(0x2B700, 0x2B740)])]
    whole = LIBRARY.encode_batch(texts, add_special_tokens=False)
    assert [t for t, found in zip(texts, whole) if ids_of(t) != found.ids] == []


def test_long_texts_come_in_parts(monkeypatch):
    text = "The cat, it's said, sat on 12 mats.\n" * 50
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 7)
    assert ids_of(text) == expected


def test_rows(spark, documents):
    texts = [None, *ODD, ODD[4], None]
    docs = documents([(i if i != 3 else None, t) for i, t in enumerate(texts)], extra=("IDS", "n_tokens", "text_2"))
    encoded = bpe.encode(docs, VOCABULARY)
    assert encoded.columns == ["doc_id", "lang", "source", "n_chars", "text_2", "n_tokens", "ids"]
    found = {r.doc_id: r for r in bpe.decode(encoded, VOCABULARY).collect()}
    for i, text in enumerate(texts):
        row = found[i if i != 3 else None]
        assert row.ids == LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(row.ids) and row.text == (text or "")
    assert bpe.encode(docs.limit(0), VOCABULARY).count() == 0
    short = bpe.decode(encoded, VOCABULARY, keep_ids=False)
    assert short.columns == ["doc_id", "lang", "source", "n_chars", "text_2", "n_tokens", "text"]
    assert {r.doc_id: r.text for r in short.collect()} == {i: r.text for i, r in found.items()}
    plain = bpe.encode(docs.filter("doc_id = 7"), VOCABULARY, added_as_text=True).first()
    assert 50256 not in plain.ids and found[7].ids.count(50256) == 1
    odd = spark.createDataFrame([(1, [15496, None, 999_999]), (2, None), (3, []), (4, [0xA1, 161])], "n int, ids array<int>")
    texts = {r.n: r.text for r in bpe.decode(odd, VOCABULARY).collect()}
    assert texts[1] == "Hello" and texts[2] == texts[3] == ""
    assert texts[4] == LIBRARY.decode([0xA1, 161], skip_special_tokens=False)


def test_query(spark, data):
    rows = collected(queries.op11_bpe(spark, data))
    expected = []
    for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect():
        ids = LIBRARY.encode(r.t, add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        decoded = LIBRARY.decode(ids, skip_special_tokens=False).encode()
        expected.append((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    assert rows == sorted(expected, key=repr)


def test_other_models_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="only byte-level BPE"):
        bpe.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))
