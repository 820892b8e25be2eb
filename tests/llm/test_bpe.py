import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contractlake.llm import bpe
from contractlake.llm.bpe import Encoder, decode, decode_ids, encode_texts, read_vocabulary, token_count
from contractlake.llm.settings import VOCABULARY


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(VOCABULARY)


def expected(theirs, text):
    return theirs.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(3)
    letters = "  \t\n\r'sdmtlvre aeionth123!?.-é中́\U0001f600　\x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(map(chr, rng.sample(points, 200))) for _ in range(100)]
    texts += [None, "", " ", "'", "x's't'll've ''s 's 'S", "a" * 3000, "\n" * 500 + "x", " " * 400, "ab" * 700 + " x"]
    texts += ["<|endoftext|>", "a <|endoftext|><|endoftext|>  b  <|endoftext|>", "<|endoftext| >"]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(4000))]
    return texts


def test_every_character_alone_and_in_a_word(theirs, vocabulary):
    texts = [f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    for text, ids in zip(texts, Encoder(vocabulary).encode(texts)):
        assert ids.tolist() == expected(theirs, text), text


@pytest.mark.parametrize("block", [bpe.BLOCK, 50])
def test_ids_and_texts_equal_the_library(theirs, vocabulary, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(bpe, "MAX_WORDS", 3000)
    texts = odd_texts()
    found = list(Encoder(vocabulary).encode(texts))
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == expected(theirs, text), text
        assert decode(ids, vocabulary) == theirs.decode(ids.tolist(), skip_special_tokens=False) == (text or "")


def test_ids_that_make_no_text(theirs, vocabulary):
    rng = np.random.default_rng(5)
    for _ in range(300):
        ids = rng.integers(0, 50_400, 20)
        assert decode(ids, vocabulary) == theirs.decode(ids.tolist(), skip_special_tokens=False)


def test_merges_out_of_order_are_refused(tmp_path):
    import json

    content = json.load(open(VOCABULARY, encoding="utf-8"))
    content["model"]["merges"] = content["model"]["merges"][::-1]
    path = tmp_path / "vocabulary.json"
    path.write_text(json.dumps(content))
    with pytest.raises(ValueError, match="comes before"):
        read_vocabulary(str(path))


def test_awkward_rows(theirs, crowded, no_documents):
    encoded = encode_texts(crowded, VOCABULARY)
    rows = encoded.select("row.*", "ids", token_count(F.col("ids")).alias("n")).collect()
    want = [(r.doc_id, expected(theirs, r.text), r.label) for r in crowded.collect()]
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.label) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert all(r.n == len(r.ids) // 4 for r in rows)
    back = decode_ids(encoded, VOCABULARY).select("row.row.doc_id", "text").collect()
    assert sorted(map(str, [(r.doc_id, r.text or "") for r in crowded.collect()])) == sorted(
        map(str, [tuple(r) for r in back])
    )
    assert encode_texts(no_documents, VOCABULARY).count() == 0
    assert decode_ids(encode_texts(no_documents.select("text"), VOCABULARY), VOCABULARY).count() == 0
