import random

import numpy as np
import pytest
from odd_rows import ODD

from riskwindow.llm import common, decontam

QUESTION = (
    "Alice buys 3 apples and 12 pears at the market. Each apple costs 2 dollars and each pear costs 5 cents. "
    "How much does Alice pay for the apples?"
)
OTHER = (
    "Paul buys 7 apples and 40 pears at the market. Each apple costs 9 dollars and each pear costs 11 cents. "
    "How much does Paul pay for the apples?"
)
MIXED = OTHER.replace("does Paul", "does Maria").replace("40 pears", "7 pears")


@pytest.fixture
def benchmark(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, words string")

    return build


def flagged(docs, items):
    return {(r.doc_id, tuple(r["items"])) for r in decontam.verdicts(docs, items).collect()}


def test_placeholders():
    words = decontam._Words()
    texts = ["Alice has 3 apples. The man met Orla, 5km from twenty miles.\nThe | Then he", None, "", "...", "20 kg"]
    owner, code, kind, value = decontam.templates(texts, words)
    assert kind.tolist() == [2, 0, 1, 0, 0, 0, 0, 2, 1, 3, 0, 1, 3, 0, 2, 0, 1, 3]
    assert np.bincount(owner, minlength=5).tolist() == [16, 0, 0, 0, 2]
    again = decontam.templates(["alice HAS 4 apples"], words)
    assert again[1][1:].tolist()[0] == code[1]


def test_finds_exact_and_reparameterised_questions_only(documents, benchmark):
    filler = "some words before that mean nothing at all "
    docs = documents(
        [
            (1, filler + QUESTION + " and after"),
            (2, filler + OTHER),
            (3, filler + MIXED),
            (4, filler * 5),
            (5, QUESTION[:60]),
            (6, QUESTION.upper().replace(" ", "  ")),
            *ODD[2:],
        ],
        clash=True,
    )
    found = flagged(docs, benchmark([(70, QUESTION), (71, "An unrelated item that no document has in its text at all.")]))
    assert {(1, (70,)), (2, (70,))} <= found
    assert 4 not in {i for i, _ in found} and 5 not in {i for i, _ in found}


def test_slots_must_be_consistent():
    agrees = decontam._agrees
    there, back = {}, {}
    assert agrees(there, back, [(1, 9), (2, 8)]) and there == {1: 9, 2: 8}
    assert not agrees(there, back, [(3, 7), (1, 8)]) and there == {1: 9, 2: 8}
    assert not agrees(there, back, [(4, 9)])
    same = [(i, i, [5 if k == 7 - i else 0 for k in range(8)], [6 if k == 7 - i else 0 for k in range(8)]) for i in range(8)]
    assert decontam.covered(same, 40) == 15
    broken = [(i, i, x, [v + (i > 3 and v > 0) for v in y]) for i, _, x, y in same]
    assert decontam.covered(broken, 40) == 11
    assert decontam.covered([(0, 5, [0] * 8, [0] * 8), (30, 35, [0] * 8, [0] * 8)], 60) == 8


def test_short_items_and_items_alike(documents, benchmark):
    items = benchmark([(1, "five plain words make this"), (2, "Five plain words, make this!"), (3, "too short"), (4, None), (5, "")])
    docs = documents([(1, "here five plain words make this twice"), (2, "too short"), (3, "")])
    assert flagged(docs, items) == {(1, (1, 2))}


def test_equals_brute_force(documents, benchmark):
    draw = random.Random(6)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(5, 40)))) for i in range(30)]
    rows = []
    for i in range(120):
        words = draw.choices(vocabulary, k=draw.randrange(60))
        if i % 3 == 0:
            own = items[draw.randrange(30)][1].split()
            cut = draw.randrange(1, len(own) + 1)
            words[len(words) // 2 : len(words) // 2] = own[:cut]
        rows.append((i, " ".join(words)))
    expected = set()
    for i, text in rows:
        words = text.split()
        for k, item in items:
            own = item.split()
            n = min(decontam.COVER, len(own))
            wanted = {tuple(own[j : j + n]) for j in range(len(own) - n + 1)}
            if any(tuple(words[j : j + n]) in wanted for j in range(len(words) - n + 1)):
                expected.add((i, k))
    found = flagged(documents(rows), benchmark(items))
    assert {(i, k) for i, own in found for k in own} == expected


def test_bitmap_rules_out_nothing_that_is_there(spark):
    draw = random.Random(9)
    codes = [draw.getrandbits(64) for _ in range(500)] + [0, 2**64 - 1]
    frame = spark.createDataFrame([(c - 2**64 if c >> 63 else c,) for c in codes], "code long")
    marks = common.bitmap(frame, decontam.BITS)
    assert common.marked(marks, np.array(codes, dtype=np.uint64), decontam.BITS).all()
    others = np.array([draw.getrandbits(64) for _ in range(5000)], dtype=np.uint64)
    assert common.marked(marks, others, decontam.BITS).mean() < 0.01


def test_stage_keeps_clean_rows_whole(documents, benchmark):
    docs = documents([(1, QUESTION), (2, "clean"), *ODD], clash=True)
    kept = decontam.keep_clean(docs, benchmark([(1, QUESTION)]))
    assert kept.columns == docs.columns and kept.count() == 1 + len(ODD)
    assert decontam.keep_clean(docs, benchmark([])).count() == 2 + len(ODD)
    assert decontam.keep_clean(documents([]), benchmark([(1, QUESTION)])).count() == 0


def test_copies_full_of_placeholders_are_found(documents, benchmark):
    series, title = "3 4 7 11 18 29 47 what comes next", "the Old Man And The Great Sea Of Northern Lands"
    five = "1 2 3 4 5"
    docs = documents(
        [
            (1, f"some filler, {series}, and after"),
            (2, "some filler, 3 4 7 11 18 29 48 what comes next, and after"),
            (3, f"some filler {title.lower()} and after"),
            (4, f"some filler {five} and after"),
            (5, "some filler 1 2 3 4 6 and after"),
        ]
    )
    assert flagged(docs, benchmark([(1, series), (2, title), (3, five)])) == {(1, (1,)), (3, (2,)), (4, (3,))}


def test_short_items_with_capitals_are_found_inside_sentences_and_wrapped(documents, benchmark):
    item = "What is the colour of the largest planet"
    wrapped = "The largest river\nOf all lies in\nWhich old country"
    docs = documents(
        [
            (1, f"some filler {item} and after"),
            (2, "Filler. " + item),
            (3, "some filler " + wrapped.replace("\n", " ")),
            (4, "some filler Which is the colour of the largest planet"),
        ]
    )
    assert flagged(docs, benchmark([(1, item), (2, wrapped)])) == {(1, (1,)), (2, (1,)), (3, (2,))}


def stem_corpus(seed=4):
    """Items that share stems of 8 to 20 words, with numbers; documents with stems, items, parts of them, and lists of items."""
    draw = random.Random(seed)
    plain = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    stems = [" ".join(draw.choices(plain, k=n)) for n in (8, 9, 13, 14, 20)]
    stems.append("which of 3 these 4 or 3 plain words would you say is the best 4 of all")
    items = []
    for i in range(90):
        stem = stems[i % len(stems)]
        own = " ".join(draw.choices(plain, k=draw.randrange(0, 16)))
        items.append((i, " ".join(draw.sample([stem, own], 2)) if i % 4 else f"{stem} {own}"))
    docs = []
    for i in range(160):
        words = draw.choices(plain, k=draw.randrange(20))
        for _ in range(draw.randrange(3)):
            text = draw.choice([draw.choice(stems), draw.choice(items)[1], draw.choice(items)[1]])
            own = text.split()[draw.randrange(3) :]
            if draw.random() < 0.3:
                own = [str(int(w) + 5) if w.isdigit() else w for w in own]
            words += own + draw.choices(plain, k=draw.randrange(4))
        docs.append((i, " ".join(words)))
    docs.append((500, " . ".join(t for _, t in items)))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_stems_give_what_all_pairs_give(documents, benchmark, monkeypatch, seed):
    docs, items = stem_corpus(seed)
    monkeypatch.setattr(decontam, "STEM", 10**9)
    every = {tuple(r) for r in decontam.matches(documents(docs), benchmark(items)).collect()}
    monkeypatch.setattr(decontam, "STEM", 3)
    found = [tuple(r) for r in decontam.matches(documents(docs), benchmark(items)).collect()]
    assert len(found) == len(set(found)) and set(found) == every and len(every) > 100


def test_rows_that_meet_grow_with_documents_and_items(documents, benchmark, monkeypatch):
    """A stem of eight words in all items and documents brings no pair but those that share more."""
    joined = []
    scored = decontam._scored
    monkeypatch.setattr(decontam, "_scored", lambda pairs, *rest: (joined.append(pairs.count()), scored(pairs, *rest))[1])
    stem = "please read the text and answer this question"
    word = lambda i: "".join(chr(97 + int(c)) for c in f"{i:04d}")
    own = lambda i: " ".join(f"{word(i)}{chr(97 + k)}" for k in range(12))
    counts = []
    for n in (40, 80):
        joined.clear()
        items = benchmark([(i, f"{stem} {own(i)}") for i in range(n)])
        docs = documents([(i, f"{stem} {own(i if i % 2 else 5000 + i)}") for i in range(2 * n)])
        assert {d for d, _ in flagged(docs, items)} == set(range(1, n, 2))
        counts.append(sum(joined))
    assert counts[1] <= 2.2 * counts[0]
