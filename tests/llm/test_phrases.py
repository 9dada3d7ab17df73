import random
import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import ODD

from riskwindow.llm import phrases


def brute_force(rows, threshold, first=2000, longest=4, share=80):
    """The contract with counters; no code shared with the operator."""
    count, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    count[lang, tuple(words[i : i + n])] += 1
    frequent = {k: f for k, f in count.items() if len(k[1]) > 1 and f >= threshold}
    out = {}
    for (lang, words), a in frequent.items():
        inside = any(
            other == lang and len(w) > len(words) and 100 * f >= share * a
            and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1))
            for (other, w), f in frequent.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = count[lang, words[:k]], count[lang, words[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:first])
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def texts(n=150, seed=3):
    draw = random.Random(seed)
    fixed = ["New York", "as well as", "in the long run", "ÄPFEL und Birnen", "a b a b a"]
    rows = []
    for i in range(n):
        words = [draw.choice(["the", "a", "run", "York", "x.", "y,", "z\n", "and", "ß q"]) for _ in range(30)]
        words[draw.randrange(30)] = draw.choice(fixed)
        words[draw.randrange(30)] = draw.choice(fixed)
        rows.append((i, draw.choice([" ", "  ", "\t"]).join(words), draw.choice(["en", "en", "en", "de", None, "und"])))
    return rows


@pytest.mark.parametrize("threshold", [2, 8, 30])
def test_equals_brute_force(documents, threshold):
    rows = texts()
    assert rows_of(phrases.collocations(documents(rows), threshold)) == brute_force(rows, threshold)


def test_many_parts_small_blocks_and_shares(documents, monkeypatch):
    """Blocks of a few keys, many parts of the hash space, bitmaps that are full, windows of a few rows."""
    monkeypatch.setattr(phrases, "PART", 500)
    monkeypatch.setattr(phrases, "FLUSH", 300)
    monkeypatch.setattr(phrases, "BITS", 16)
    monkeypatch.setattr(phrases, "ORDERED", 20)
    rows = texts(120, 5)
    assert rows_of(phrases.collocations(documents(rows), 5, first=7)) == brute_force(rows, 5, first=7)


def test_odd_rows_clashing_columns_and_no_rows(documents):
    rows = [(i, t, None) for i, t in ODD] + [(9, "one one one", "en"), (9, "one one one", "en")]
    assert rows_of(phrases.collocations(documents(rows, clash=True), 2)) == brute_force(rows, 2)
    assert rows_of(phrases.collocations(documents([]), 2)) == []
    assert rows_of(phrases.collocations(documents([(1, None), (2, " ,. ")]), 1)) == []


def test_very_long_text_in_parts(documents, monkeypatch):
    rows = [(1, "one two three. " * 40_000 + "w" * 300_000, "en"), (2, "two three, four", "en")]
    assert rows_of(phrases.collocations(documents(rows), 30)) == brute_force(rows, 30)


def test_counts_beyond_64_bits(spark, documents, monkeypatch):
    """Scores are exact where 2,000,000 times a count passes 64 bits."""
    big = 9 * 10**17
    known = spark.createDataFrame(
        [("en", 0, "", 4 * big), ("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 5)],
        "lang string, words int, phrase string, f long",
    )
    monkeypatch.setattr(phrases, "frequencies", lambda *_: known)
    row = phrases.collocations(documents([])).first()
    assert row.score == 2_000_000 * (big - 5) // (2 * big + 1) and row.n == 4 * big


@pytest.mark.parametrize("seed", range(5))
def test_no_frequent_key_is_lost(seed):
    """Blocks merged in any order keep what occurs often enough, in bounded space."""
    draw = np.random.default_rng(seed)
    keys = draw.zipf(1.3, 20_000).astype(np.uint64) % np.uint64(5000)
    blocks = []
    for part in np.array_split(keys, 37):
        found, counts = np.unique(part, return_counts=True)
        blocks.append((found, counts.astype(np.uint32)))
    draw.shuffle(blocks)
    whole = Counter(keys.tolist())
    for threshold in (2, 30, 200, 20_001):
        often = {k for k, n in whole.items() if n >= threshold}
        left = set(phrases.survivors(blocks, threshold).tolist())
        assert often <= left and len(left) <= len(keys) // threshold


def test_a_summary_keeps_its_capacity():
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    summary = none
    for i in range(50):
        hashes = np.arange(i, i + 100, dtype=np.uint64)
        summary = phrases.merged(summary, hashes, np.full(100, 1 + i % 3), 40)
        assert len(summary[0]) <= 40
