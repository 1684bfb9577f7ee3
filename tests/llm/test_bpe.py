"""The backtracking encoder against the tokenizers library, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edgeframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "ß", "😀", "\x1c", "\x85", "　", "'s", "'ll", "1", "²", "١", "Ⅷ",
       "<|endoftext|>", "<|endo", "्", "क", "中", "\x00", "!!", "aaaaaaaa", "\xa0", "ǅ", "́", "ÿ", "×", "ª"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_same_ids_as_the_library(library):
    r = random.Random(5)
    texts = ["".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(r.choice("ab ") for _ in range(r.randint(1, 60))) for _ in range(500)]
    ids, ends = bpe.vocabulary(PATH).encode(texts)
    for text, own in zip(texts, np.split(ids, ends[:-1])):
        want = library.encode(text, add_special_tokens=False).ids
        assert own.tolist() == want, repr(text)
        assert bpe.vocabulary(PATH).decode(own).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_long_pieces_are_linear(library):
    text = "a" * 100_000 + "b" * 1000 + "ab" * 5000
    assert bpe.vocabulary(PATH).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_pieces_are_not_kept(library):
    made = bpe.vocabulary(PATH)
    made.memo.clear()
    text = " ".join("".join(random.Random(k).choice("abcdef") for _ in range(10 + k)) for k in range(100))
    assert made.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert made.memo and max(map(len, made.memo)) == bpe.MEMO_PIECE


def test_documents(spark, library):
    rows = [(1, "Hello world"), (2, ""), (3, None), (None, "x"), (1, "Hello world"), (4, "é" * 30_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, ids int")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert sorted(map(tuple, bpe.digests(docs, PATH).collect()), key=repr) == sorted(want, key=repr)
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((d, t or "") for d, t in rows), key=repr)
    assert bpe.digests(docs.limit(0), PATH).count() == 0
