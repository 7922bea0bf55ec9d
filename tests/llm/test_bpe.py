import hashlib
import random

import pytest

from starglean.llm.bpe import Automaton, Encoder, encode_decode, encoding_digest, read_vocabulary
from starglean.llm.vocabulary import byte_bpe_path

ODD = [
    "", " ", "  ", "a  b", "a \n b", "\n \n x", " \n\nfoo  ", "x<|endoftext|> y", "\n <|endoftext|>b <|endoftext|>", "a" * 50,
    "I'm you'll's 's", "日本語 テスト　x   y", "é‍👩‍👩", "\x00\x1c\x1d a\x1c b", "1²³ ½ Ⅻ", "\t\t\tx", "-" * 300 + " " * 50,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe_path())


def test_equals_library_on_odd_and_random_texts(library):
    ours = Encoder(read_vocabulary(byte_bpe_path()))
    draw = random.Random(9)
    texts = list(ODD)
    for alphabet in ("ab \n\té'<|>endoftext 1½!? 日", ["th", "e", " ", "er", "in", "\n", "a", "0", "ing"]):
        texts += ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 40))) for _ in range(3000)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids, repr(text)
        assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_gadgets_on_a_tiny_vocabulary():
    import json

    vocab = {c: i for i, c in enumerate("abc")} | {"aa": 3, "ab": 4, "aab": 5, "bc": 6}
    file = json.dumps({"model": {"type": "BPE", "vocab": vocab, "merges": ["a a", "a b", "aa b", "b c"]}, "pre_tokenizer": {"type": "ByteLevel"}})
    automaton = Automaton(file.encode())
    assert automaton.encode_word(b"aaa") == (3, 0)
    assert automaton.encode_word(b"aab") == (5,)
    assert automaton.encode_word(b"abc") == (4, 2)
    assert automaton.encode_word(b"aaabc") == (3, 4, 2)
    assert not automaton.arc(0, 0) and automaton.arc(3, 3)


def test_rows_as_they_are(spark, library):
    rows = [(1, None, 5), (1, "same", 6), (1, "same", 6), (None, "no id", 7), (2, "word " * 30_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = encode_decode(docs, byte_bpe_path()).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((i or 0, t or "") for i, t, _ in rows)
    assert all(r.ids == library.encode(r.decoded, add_special_tokens=False).ids for r in got)
    digest = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoding_digest(docs, byte_bpe_path()).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (1, 0, sha(""), sha("")) in digest
    assert encoding_digest(docs.limit(0), byte_bpe_path()).collect() == []


def test_documents_as_the_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in encoding_digest(docs, byte_bpe_path()).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
