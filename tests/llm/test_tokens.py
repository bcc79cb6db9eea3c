from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textlake.llm import bpe_stream, token_files

SCHEMA = "doc_id long, text string"
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\t ", "Hello World", "it's we'll <|endoftext|> x<|endoftext|>", "<|startoftext|>a", "é \x1c a\x1c b",
    "  two  blanks  ", "a\x85 b 日本語 🙂🙂 x", "=" * 3000 + "  " * 900 + "ab" * 2000, "a\0b", "é ́x", "　x  y", "x" * 5000,
]


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}


@pytest.fixture(scope="module")
def transducer():
    with open(BYTES, encoding="utf-8") as file:
        return bpe_stream.transducer(file.read())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=3000))
def test_words_hold_all_ids(ids):
    ids = np.array(ids, "uint64")
    words, starts = token_files.encode_blocks(ids)
    assert token_files.decode_blocks(words, starts, len(ids)).tolist() == ids.tolist()


def test_words_are_dense():
    ids = np.random.default_rng(1).integers(0, 1 << 20, 30_000).astype("uint64")
    words, _ = token_files.encode_blocks(ids)
    assert len(words) <= 10_000 + 30


def docs_of(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    alphabet = " \n\t　\x1c\x85'abtséABÉ1２½🙂-.<|>"
    docs = [(i, t) for i, t in enumerate(ODD)]
    docs += [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80)))) for i in range(200)]
    docs += [(100, "the same id"), (100, "the same id"), (None, "no id"), (-4, "negative id")]
    rng.shuffle(docs)
    return docs


def test_token_files(spark, libraries):
    docs = docs_of(1)
    df = spark.createDataFrame(docs, SCHEMA).withColumn("start", F.lit("x")).repartition(4)
    rows = token_files.written_tokens(df, WORDS).collect()
    found, at = [], 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        found.append(r["doc_id"])
    assert found == sorted((i for i, _ in docs), key=lambda i: (i is None, i))
    expected = []
    for i, t in docs:
        ids = np.array([*libraries[WORDS].encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((i, len(ids), zlib.crc32(ids.tobytes())))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=key) == sorted(expected, key=key)
    assert token_files.written_tokens(spark.createDataFrame([], SCHEMA), WORDS).count() == 0


def test_ids_and_decoded_text(spark, libraries):
    docs = docs_of(2)
    df = spark.createDataFrame(docs, SCHEMA).withColumn("ids", F.lit("x"))
    expected = []
    for i, t in docs:
        ids = libraries[BYTES].encode(t or "", add_special_tokens=False).ids
        text = libraries[BYTES].decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), text.encode())]
        expected.append((i, len(ids), *sha))
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in bpe_stream.digested(df, BYTES).collect()), key=key) == sorted(expected, key=key)
    assert bpe_stream.digested(spark.createDataFrame([], SCHEMA), BYTES).count() == 0


@pytest.mark.parametrize("alphabet", [b"ab", b"aeiou", b"the rain", b"=-", b" ", b"thingeraton", bytes(range(256))])
def test_windows_give_the_same_ids(transducer, alphabet):
    merges, rng = transducer.merges, random.Random(3)
    piece = bytes(rng.choice(alphabet) for _ in range(12_000))
    streamed = list(merges.stream(piece, 2 * merges.lookahead))
    whole = merges.merged([merges.single[b] for b in piece])
    assert [i for some in streamed for i in some] == whole
    assert all(len(some) <= 4 * merges.lookahead for some in streamed)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_any_text(transducer, libraries, text):
    ids = [i for some in transducer.encode(text) for i in some]
    assert ids == libraries[BYTES].encode(text, add_special_tokens=False).ids
    assert "".join(transducer.decode(ids)) == libraries[BYTES].decode(ids, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_255), max_size=60))
def test_any_ids(transducer, libraries, ids):
    assert "".join(transducer.decode(ids)) == libraries[BYTES].decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("word", ["слово", "mots", "été", "中", "á", "ß"])
def test_texts_of_any_script_take_linear_time(transducer, libraries, word):
    """Every word is a stretch of its own, and long texts are cut in chunks."""
    text = f"{word} " * 200_000
    transducer.forget()
    most = max(len(b) for b in transducer.blobs(text))
    assert most <= 4 * bpe_stream.STRETCH
    short = text[: 5000 * (len(word) + 1)] + "  \n" + " " * 3000 + word
    assert [i for some in transducer.encode(short) for i in some] == libraries[BYTES].encode(short, add_special_tokens=False).ids


def test_chunks_change_nothing(transducer, libraries, monkeypatch):
    monkeypatch.setattr(bpe_stream, "CHUNK", 7)
    for _, text in docs_of(5):
        ids = [i for some in transducer.encode(text or "") for i in some]
        assert ids == libraries[BYTES].encode(text or "", add_special_tokens=False).ids


def test_memory_is_bounded_and_freed(transducer, libraries, monkeypatch):
    monkeypatch.setattr(bpe_stream, "REMEMBERED", 5000)
    text = " ".join(f"word{i}" for i in range(2000))
    ids = [i for some in transducer.encode(text) for i in some]
    assert transducer.held <= 5000 + 1000 and len(transducer.known) < 40
    assert ids == libraries[BYTES].encode(text, add_special_tokens=False).ids
    list(bpe_stream.encoded(iter([]), open(BYTES, encoding="utf-8").read()))
    assert not bpe_stream.transducer(open(BYTES, encoding="utf-8").read()).known


def test_memory_of_words_is_bounded(libraries, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_BYTES", 20_000)
    monkeypatch.setattr(token_files, "NEW_WORDS", 40)
    rng = random.Random(7)
    letters = "abcdeIJé'.,!"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(200)) for _ in range(30)] + ODD
    with open(WORDS, encoding="utf-8") as file:
        own = token_files.Encoder(file.read())
    for i in range(0, len(texts), 4):
        ids, sizes = own.encode(pa.array(texts[i : i + 4], pa.string()))
        expected = [[*libraries[WORDS].encode(t or "", add_special_tokens=False).ids, 1] for t in texts[i : i + 4]]
        assert sizes.tolist() == list(map(len, expected)) and ids.tolist() == [x for e in expected for x in e]
        # what a chunk of new words adds at most, their parts included
        assert own.held <= 20_000 + 3 * 40 * (token_files.WORD_BYTES + 100) + 8 * 5000


@pytest.fixture(scope="module")
def encoder():
    with open(WORDS, encoding="utf-8") as file:
        return token_files.Encoder(file.read())


def test_pieces_are_learned_once(encoder, libraries, monkeypatch):
    """Case, signs and accents make no new pieces, and only words with other characters take all rules."""
    encoder.clear()
    asked, by_rules = [], encoder.by_rules
    monkeypatch.setattr(encoder, "by_rules", lambda words: asked.extend(words) or by_rules(words))
    text = "Été, été. ÉTÉ $$$ été$$$ (Mots) mots12 it's ÿ×ÿ ½ ÀÖØÞßàöøþÿ"
    ids, sizes = encoder.encode(pa.array([text, None, text], pa.string()))
    assert sorted(asked) == sorted(["it's", "ÿ×ÿ", "½"])
    assert set(encoder.known) == {"été", ",", ".", "$$$", "(", "mots", ")", "1", "2", "àöøþßàöøþÿ", *asked}
    expected = [*libraries[WORDS].encode(text, add_special_tokens=False).ids, 1]
    assert ids.tolist() == [*expected, 1, *expected] and sizes.tolist() == [len(expected), 1, len(expected)]


CHARACTERS = [*map(chr, range(0x250)), *"\u0301\u0327\u0130\u1e9e\u2028\u3000Σς中🙂", "'s", "'LL", "<|endoftext|>", "<|STARTOFTEXT|>"]


def test_sums_are_those_of_the_ids_read(spark):
    listed = token_files.write_tokens(spark.createDataFrame(docs_of(4), SCHEMA), WORDS)
    checked = token_files.checked_tokens(listed)
    ids = token_files.read_tokens(listed).collect()
    expected = [(r["start"], r["doc_id"], r["n_tokens"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in ids]
    assert sorted(expected) == sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in checked.collect())
    # one Python worker for each task: ids don't pass through the JVM
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30) | st.lists(st.sampled_from(CHARACTERS), max_size=60).map("".join), max_size=4))
def test_pieces_of_any_text(encoder, libraries, texts):
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    expected = [[*libraries[WORDS].encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert sizes.tolist() == list(map(len, expected)) and ids.tolist() == [x for e in expected for x in e]


@pytest.mark.parametrize("size", [1, 7, 50, 1000])
def test_parts_of_long_texts(encoder, libraries, monkeypatch, size):
    monkeypatch.setattr(token_files, "PIECE", size)
    texts = [t for _, t in docs_of(6)]
    data, _ = token_files.text_bytes(pa.array(texts, pa.string()))
    found = list(token_files.chunks(data))
    assert len(found) > 1 and [x for x, _ in found] == [0, *(x for _, x in found[:-1])] and found[-1][1] == len(data)
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    expected = [[*libraries[WORDS].encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert sizes.tolist() == list(map(len, expected)) and ids.tolist() == [x for e in expected for x in e]


def test_each_character_beside_others(encoder, libraries):
    for character in CHARACTERS:
        texts = [f"a{character}b", f"{character}É", f"é{character} {character}1", f"{character}{character}", f"9{character}!"]
        ids, _ = encoder.encode(pa.array(texts, pa.string()))
        assert ids.tolist() == [x for t in texts for x in [*libraries[WORDS].encode(t, add_special_tokens=False).ids, 1]]


@pytest.mark.parametrize("most", [1, 700, 5000, 1_000_000])
def test_files_are_read_by_parts(spark, libraries, most):
    docs = docs_of(3)
    df = spark.createDataFrame(docs, SCHEMA).coalesce(1)
    listed = token_files.write_tokens(df, WORDS).orderBy("part").collect()
    parts = [part for r in listed for part in token_files.read_file(r["path"], most)]
    assert all(len(ids) <= most or len(sizes) == 1 for ids, _, sizes, _ in parts)
    expected = [[*libraries[WORDS].encode(t or "", add_special_tokens=False).ids, 1] for _, t in docs]
    found = [ids.tolist() for some, _, sizes, _ in parts for ids in np.split(some, np.cumsum(sizes)[:-1])]
    assert sorted(found) == sorted(expected)
