import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from odd_rows import ODD

from riskwindow.llm import bpe


@pytest.fixture(scope="module")
def words():
    return bpe.vocabulary()


@pytest.fixture(scope="module")
def library(words):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.rank, special_tokens={}
    )


def test_encodes_like_the_library_and_decodes_back(words, library):
    draw = random.Random(4)
    letters = [*map(chr, range(32, 127)), *"äöüéñçßŒ漢字かな한글🙂\n\t\r   "]
    texts = ["".join(draw.choices(letters, k=draw.randrange(80))) for _ in range(3000)]
    texts += ["<|endoftext|> 's 're", "a" * 600, "ab" * 3000, "é" * 513, " " * 700, "!" * 9, "the" * 200, "\n\n x"]
    for text, ids in zip(texts, words.encode(texts)):
        assert ids == library.encode_ordinary(text)
        assert words.decode(ids) == text.encode()


def test_long_and_short_pieces_are_merged_alike(words):
    draw = random.Random(2)
    pieces = [bytes(draw.choices(b"abcdeth in", k=draw.randrange(2, 40))) for _ in range(2000)]
    assert words.merge_rows(pieces, 64) == [words.merge_long(p) for p in pieces]


def test_pair_table_knows_every_pair_and_no_other(words):
    pairs = list(words.pairs)[::97]
    left, right = (bpe.np.array(x, dtype=bpe.np.int32) for x in zip(*pairs))
    assert words.pair_ranks(left, right).tolist() == [words.pairs[p] for p in pairs]
    assert (words.pair_ranks(left, left.max() - left) == [words.pairs.get((a, left.max() - a), bpe._NONE) for a in left]).all()


def test_digests_of_documents(documents, library):
    rows = [(7, "The rain in Spain. " * 3000), (5, "naïve\n\n  café 123"), *ODD]
    found = bpe.digests(documents(rows, clash=True)).collect()

    def expected(text):
        ids = library.encode_ordinary(text or "")
        return (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        )

    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(
        (str(i), *expected(t)) for i, t in rows
    )


def test_ids_of_documents(documents, library):
    rows = bpe.encoded(documents([(1, "one two"), (2, None)])).orderBy("doc_id").collect()
    assert rows[0].ids == library.encode_ordinary("one two") and bytes(rows[0].decoded) == b"one two"
    assert rows[1].ids == [] and bytes(rows[1].decoded) == b""


def test_known_pieces_may_be_dropped_at_any_time(documents, monkeypatch):
    texts = [(i, f"alpha{i} beta{i % 3} gamma") for i in range(50)]
    whole = sorted(map(tuple, bpe.digests(documents(texts)).collect()))
    words, ids = bpe.vocabulary(), {}
    for i, t in texts:
        ids[i] = len(words.encode([t])[0])
    assert [r[1] for r in whole] == [ids[r[0]] for r in whole]


def test_no_rows(documents):
    assert bpe.digests(documents([])).count() == 0
