"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from chronofold.llm import bpe
from chronofold.llm.queries import TOKENIZER, op12_bpe
from tests.llm.conftest import EDGE, rows

PATH = TOKENIZER["tokenizer"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def assert_same(texts, library):
    own = bpe.Vocabulary.of(PATH)
    counts, ids = own.encode(texts)
    at = 0
    for text, n in zip(texts, counts):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids[at : at + n].tolist() == expected, text[:100]
        assert own.decode(expected) == library.decode(expected, skip_special_tokens=False)
        at += n
    assert at == len(ids)


def test_edge_texts(library):
    special = ["<|endoftext|>", "x<|endoftext|>y <|endoftext|><|endoftext|> ", "<|endoftext", "\x1c\x85  x"]
    runs = [c * n for c in ("a", " ", "é", "1", "\n", "ab", "Ġ", "!") for n in (1, 2, 31, 63, 64, 65, 66, 200, 3000)]
    assert_same(["", *special, *runs, "it's we'll 'S I'm'd"], library)


def test_random_texts(library):
    rng = random.Random(1)
    ranges = [(32, 127), (0, 0x700), (0x4E00, 0x9FFF), (0x1F300, 0x1FAFF), (0, 0xD800), (0xE000, 0x110000)]
    texts = ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(150))) for _ in range(400)]
    words = ["".join(rng.choice("abeinorst" + "e" * k) for _ in range(rng.randrange(1, 400))) for k in range(300)]
    assert_same(texts + words, library)


def test_both_forms_of_the_tree_agree():
    own, rng = bpe.Vocabulary.of(PATH), random.Random(2)
    for size in (1, 2, 3, 9, 33, 64, 65):
        words = ["".join(rng.choice("aehinorst ") for _ in range(size)).encode() for _ in range(50)]
        width = 1 << max(size - 2, 0).bit_length()
        counts, ids = own.merge_rows(words, width)
        alone = [own.merge_long(w).tolist() for w in words]
        assert ids.tolist() == [i for ids_ in alone for i in ids_] and counts.tolist() == list(map(len, alone))


def test_words_are_forgotten_within_a_bound(library, monkeypatch):
    monkeypatch.setattr(bpe, "HELD", 10)
    assert_same(["alpha beta gamma"], library)
    assert_same(["delta alpha epsilon"], library)
    assert bpe.Vocabulary.of(PATH).size < 30


def test_decode_of_broken_and_unknown_ids(library):
    own = bpe.Vocabulary.of(PATH)
    for ids in ([128], [0, 50256, 128, 200], [60_000], []):
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark, sf_dir, texts, library):
    got = op12_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edge_rows(edge, empty):
    made = bpe.decode_documents(bpe.encode_documents(edge, PATH), PATH)
    assert rows(made, "doc_id", "decoded") == sorted(
        ((r[0], r[1] or "") for r in EDGE), key=lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    )
    assert bpe.decode_documents(bpe.encode_documents(empty, PATH), PATH).count() == 0
    with pytest.raises(ValueError):
        bpe.decode_documents(made, PATH)


def test_null_ids_decode_to_an_empty_text(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [64])], "doc_id long, ids array<int>")
    assert rows(bpe.decode_documents(df, PATH), "doc_id", "decoded") == [(1, ""), (2, ""), (3, "a")]
