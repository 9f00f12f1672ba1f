"""The rank-array codec against the library as it comes, special strings included."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from medloom.llm import bytepairs

from .test_operators_llm import ODD, by_id, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
STRANGE = [
    (50, "a <|endoftext|> b"), (51, "<|endoftext|><|endoftext|>"), (52, "<|endoftext"), (53, "x<|endoftext|>  <|endoftext|> "), (54, "՘ a՘b 𐥀 1ಜ!"),
    (55, "a   b\t \n c\r\n  \x85 \xa0d\x1c e"), (56, "don't WE'LL 'Re 123456 ½ ²³"), (57, "é" * 300), (58, "".join(chr(0x4E00 + i % 900) for i in range(3000))),
    (59, "ab" * 20000), (60, " "), (61, "�​᠎ x"), (62, "á́ b"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_texts_equal_the_library(spark, docs, library):
    rows = ODD + STRANGE + prose(60, 4)
    got = by_id(bytepairs.encode_decode(docs(rows), PATH, with_ids=True))
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        for r in got[i]:
            assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), back), i
            assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert len(got[8]) == 2 and bytepairs.encode_decode(docs([]), PATH).count() == 0


def test_scan_and_heap_take_the_same_steps(library):
    code, r = bytepairs.BytePairs(PATH), random.Random(2)
    for alphabet in ("ab", "aeinorst", "the ing", "éüß漢", "\x00\xff 1"):
        for n in (0, 1, 2, 3, 17, 60, 400):
            word = "".join(r.choice(alphabet) for _ in range(n)).encode()
            assert code.scan(word) == code.heap(word) and code.decode(code.scan(word)) == word


def test_memory_starts_afresh(library, monkeypatch):
    monkeypatch.setattr(bytepairs, "REMEMBERED", 3)
    code = bytepairs.BytePairs(PATH)
    for text in ("one two three four five one two", "six one two seven"):
        assert code.text(text)[0] == ",".join(map(str, library.encode(text).ids))
    assert len(code.runs) <= 3 and len(code.runs.older) <= 3
