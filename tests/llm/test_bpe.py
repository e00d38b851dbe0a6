import array
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from partlens.llm import bpe
from tests.llm.cases import table

PATH = public_tokenizers.path("word_bpe_49k.json")
POOL = [*map(chr, range(32, 127))] + list("éÉΣςİßẞ中가ᄀ٠²Ⅰ̧́‍\U0001f600\xa0\x85\x1c  \n\t")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def same(ours, theirs, text):
    ids = theirs.encode(text, add_special_tokens=False).ids
    packed = ours.encode(text)
    assert list(array.array("I", packed)) == ids, text
    assert ours.decode(packed) == theirs.decode(ids, skip_special_tokens=False), text


def test_random_text(ours, theirs):
    rng = random.Random(3)
    for _ in range(4000):
        same(ours, theirs, "".join(rng.choices(POOL, k=rng.randrange(40))))


def test_long_words_and_special_tokens(ours, theirs):
    rng = random.Random(4)
    for size in (bpe.SHORT_WORD - 1, bpe.SHORT_WORD, bpe.SHORT_WORD + 1, 3000):
        same(ours, theirs, "".join(rng.choices("abcdeinthr", k=size)))
        same(ours, theirs, "a" * size + "!" * size)
    same(ours, theirs, "x<|endoftext|>Y<|startoftext|><|endoftext|> <|endoftext| <|ENDOFTEXT|>")


def test_scan_and_queue_agree(ours):
    rng = random.Random(5)
    for _ in range(2000):
        word = "".join(rng.choices("abcdeinthrs", k=rng.randrange(1, 60)))
        assert ours._scan(word) == ours._queue(word)


def test_small_caches_change_nothing(ours, theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 3)
    monkeypatch.setattr(bpe, "CACHED_PIECES", 2)
    for row in table()[:12]:
        same(ours, theirs, row[1] or "")


def test_rows(docs, theirs):
    rows = bpe.round_trip(docs, PATH).select("doc_id", bpe.unpacked().alias("ids"), "decoded").collect()
    want = [(r[0], theirs.encode(r[1] or "", add_special_tokens=False).ids) for r in table()]
    assert sorted([(r.doc_id, [int(i) for i in r.ids]) for r in rows], key=str) == sorted(want, key=str)
    assert sorted(r.decoded for r in rows) == sorted(theirs.decode(i, skip_special_tokens=False) for _, i in want)


def test_empty(empty):
    assert bpe.round_trip(empty, PATH).collect() == []
