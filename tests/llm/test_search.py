import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import ODD

from riskwindow.llm import search


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute_force(docs, items, first=50):
    """Every document scored for every item; no code shared with the operator."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, query in asked.items():
        scores = []
        for doc, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * n // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in query if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scores[:first])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def corpus(n=300, seed=1):
    """Words of very unequal frequency, copies of texts, ties."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["Äß", "naïve", "x9", "the"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(draw.randrange(10**6), " ".join(draw.choices(vocabulary, weights, k=draw.randrange(1, 80)))) for _ in range(n)]
    docs += [(i + 10**7, t) for i, t in docs[:40]]
    asked = [(i, "-".join(draw.sample(vocabulary, 6)) + " The, THE") for i in range(12)]
    return docs, asked


@pytest.mark.parametrize("first", [1, 5, 50, 1000])
def test_equals_brute_force(documents, items, first):
    docs, asked = corpus()
    assert rows_of(search.ranked(documents(docs), items(asked), first)) == brute_force(docs, asked, first)


def test_small_shards_and_blocks(documents, items, monkeypatch):
    monkeypatch.setattr(search, "POSTINGS", 40)
    monkeypatch.setattr(search, "BLOCK", 300)
    docs, asked = corpus(200, 2)
    assert rows_of(search.ranked(documents(docs), items(asked), 7)) == brute_force(docs, asked, 7)


def test_odd_rows_clashing_columns_and_no_rows(documents, items):
    docs = [*ODD, (7, "One, one; ONE two"), (8, "öne two"), (None, "one two"), (9, "\x00one\x7ftwo")]
    asked = [(1, "one"), (1, "two"), (2, None), (3, " .. "), (None, "two"), (4, "absent"), (5, "one one"), (5, "one one")]
    expected = brute_force(docs, asked)
    assert rows_of(search.ranked(documents(docs, clash=True), items(asked))) == expected
    assert search.ranked(documents([]), items(asked)).count() == 0
    assert search.ranked(documents(docs), items([])).count() == 0
    assert search.ranked(documents([(1, None), (2, "")]), items(asked)).count() == 0


def test_repeated_documents_and_ties_at_the_end(documents, items):
    docs = [(5, "a b"), (5, "a b"), (3, "a b"), (9, "a b"), (1, "c d"), (2, "c d e")]
    asked = [(1, "a"), (2, "c")]
    assert rows_of(search.ranked(documents(docs), items(asked), 2)) == brute_force(docs, asked, 2)


def test_very_long_text(documents, items):
    docs = [(1, "alpha beta " * 500_000), (2, "alpha"), (3, "beta gamma"), (4, "x" * 5_000_000)]
    asked = [(1, "alpha gamma"), (2, "beta")]
    assert rows_of(search.ranked(documents(docs), items(asked))) == brute_force(docs, asked)


@pytest.mark.parametrize("seed", range(20))
def test_accumulators_are_limited_and_exact(seed):
    """Documents that get none cannot be among the first; all others have their whole score."""
    draw = np.random.default_rng(seed)
    documents, first = 400, int(draw.integers(1, 20))
    lists = []
    for size, top in ((5, 3000), (20, 1500), (100, 300), (300, 40), (390, 9)):
        docs = np.sort(draw.choice(documents, size, replace=False))
        lists.append((docs, draw.integers(0, top, size)))
    whole = np.zeros(documents, dtype=np.int64)
    for docs, amounts in lists:
        whole[docs] += amounts
    found = search.accumulated(lists, documents, first, 0)
    kth = np.sort(whole)[-first]
    assert (found[whole >= max(kth, 1)] == whole[whole >= max(kth, 1)]).all()
    assert (found[found > 0] <= whole[found > 0]).all()
    assert (found > 0).sum() < (whole > 0).sum()
    carried = search.accumulated(lists, documents, first, int(kth))
    assert (carried[whole >= max(kth, 1)] == whole[whole >= max(kth, 1)]).all()
