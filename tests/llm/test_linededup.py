import random

import numpy as np
from odd_rows import ODD

from riskwindow.llm import linededup

LONG = [f"line {i} of a text that is long enough to be an anchor" for i in range(40)]


def kept(docs):
    return [(r.row.doc_id, r.kept, r.n_lines, r.n_deleted) for r in linededup.without_blocks(docs).collect()]


def test_alignment_is_increasing_and_of_equal_lines():
    draw = random.Random(3)
    for _ in range(2000):
        a = [draw.randrange(9) for _ in range(draw.randrange(14))]
        b = [draw.randrange(9) for _ in range(draw.randrange(14))]
        found = linededup.aligned(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
    assert linededup.aligned(list("abcxyzdef"), list("abcdef")) == [(0, 0), (1, 1), (2, 2), (6, 3), (7, 4), (8, 5)]
    assert linededup.aligned(list("pqaXrs"), list("ttaXuu")) == [(2, 2), (3, 3)]


def test_longest_increasing_run():
    draw = random.Random(7)
    for _ in range(300):
        values = draw.sample(range(12), 9)
        best = [1] * 9
        for k in range(9):
            best[k] += max([best[j] for j in range(k) if values[j] < values[k]], default=0)
        found = linededup._increasing([(v, j) for j, v in enumerate(values)])
        assert len(found) == max(best) and found == sorted(found)


def test_common_block_leaves_the_later_document(documents):
    rows = [
        (5, "\n".join(["mine"] + LONG[:4] + ["end"])),
        (3, "\n".join(["first"] + LONG[:4])),
        (8, "\n".join(LONG[2:4] + ["something else", "  " + LONG[0] + "\t"])),
        (9, "nothing\nin common"),
    ]
    found = {r[0]: r[1:] for r in kept(documents(rows, clash=True))}
    assert found[3] == (rows[1][1], 5, 0)
    assert found[5] == ("mine\nend", 6, 4)
    # The alignment keeps the order: the line that has moved stays.
    assert found[8] == ("something else\n  " + LONG[0] + "\t", 4, 2)
    assert found[9] == (rows[3][1], 2, 0)


def test_short_common_lines_stay(documents):
    rows = [(i, f"Licence notice of everyone\nown text {i} that nobody else has got") for i in range(60)]
    assert all(n == 0 for *_, n in kept(documents(rows)))


def test_every_block_is_kept_once_in_a_large_group(documents):
    # Near copies: each shares all but one line with the others.
    rows = [(i, "\n".join([*LONG[:9], f"own line of document {i} with some more words"])) for i in range(150)]
    found = sorted(kept(documents(rows)))
    assert found[0][3] == 0 and found[0][1] == rows[0][1]
    assert [r[1] for r in found[1:]] == [r[1].split("\n")[-1] for r in rows[1:]]


def test_odd_rows(documents):
    rows = [*ODD, (7, "\n".join(LONG[:3])), (6, "\n".join(LONG[:3])), (6, "\n".join(LONG[:3])), (None, LONG[0] + "\n" + LONG[1])]
    found = kept(documents(rows, clash=True))
    assert len(found) == len(rows)
    said = sorted((str(i), str(t), n, gone) for i, t, n, gone in found)
    block = "\n".join(LONG[:3])
    assert said == sorted(
        [
            ("1", "None", 0, 0), ("2", "", 0, 0), ("3", " \n\t ", 2, 0), ("None", "a text without an id", 1, 0),
            ("4", "one", 1, 0), ("4", "one", 1, 0), ("None", "None", 0, 0),
            ("7", "", 3, 3), ("6", block, 3, 0), ("6", block, 3, 0), ("None", "", 2, 2),
        ]
    )


def test_very_long_text(documents):
    lines = [f"line number {i} of a very long document" for i in range(30_000)]
    found = dict((r[0], r[1:]) for r in kept(documents([(1, "\n".join(lines)), (2, "\n".join(["new", *lines[5:]]))])))
    assert found[2] == ("new", 29_996, 29_995)


def test_stage_drops_emptied_documents_and_counts_characters(documents):
    docs = documents([(1, "\n".join(LONG[:3])), (2, "\n".join(LONG[:3])), (3, "x\n" + "\n".join(LONG[:3])), (4, "")], clash=True)
    left = linededup.drop_blocks(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in left.collect()) == [
        (1, "\n".join(LONG[:3]), len("\n".join(LONG[:3]))), (3, "x", 1), (4, "", 0),
    ]


def test_no_rows(documents):
    assert kept(documents([])) == [] and linededup.drop_blocks(documents([])).count() == 0


def test_copies_made_of_short_lines_are_cut(documents):
    lines = [f"short {i:04d}" for i in range(1000)]
    found = {r[0]: r[1:] for r in kept(documents([(1, "\n".join(lines)), (2, "\n".join(["new", *lines])), (3, "\n".join(lines[7:13]))]))}
    assert found == {1: ("\n".join(lines), 1000, 0), 2: ("new", 1001, 1000), 3: ("", 6, 6)}


def test_windows_of_equal_lines_are_equal_wherever_they_lie():
    lines, sizes = np.array([5, 6, 7, 5, 6, 9, 9, 5, 6, 7], dtype=np.uint64), np.array([30, 0, 30, 30, 0, 60, 9, 30, 0, 30])
    who, code, always = linededup.windows(lines, sizes, np.array([3, 7, 7, 10]))
    own = [set(code[who == k].tolist()) for k in range(4)]
    assert own[0] == own[3] and len(own[0]) == 4 and not own[2] and own[0] & own[1] == {5}
    assert code[~always].tolist() == [5, 7, 5, 9, 5, 7]


def test_repeated_and_moved_blocks_are_cut(documents):
    passage, other = LONG[:5], LONG[5:9]
    rows = [
        (1, "\n".join(["a", *passage, "b", *passage, "c"])),
        *[(i, "\n".join([f"p{i}", *passage, f"q{i}"])) for i in (2, 3, 4)],
        (10, "\n".join([*other, "between"])),
        *[(i, "\n".join([f"p{i}", *other, *passage, f"q{i}"])) for i in (11, 12)],
        (13, "\n".join([*passage, "middle", *other])),
        (14, f"x\n{LONG[20]}\ny\n{LONG[20]}\nz"),
        (15, f"r\n{LONG[20]}\ns"),
    ]
    found = {r[0]: r[1] for r in kept(documents(rows))}
    assert found[1] == rows[0][1] and found[10] == rows[4][1]
    assert [found[i] for i in (2, 3, 4, 11, 12)] == [f"p{i}\nq{i}" for i in (2, 3, 4, 11, 12)]
    assert found[13] == "middle" and found[15] == "r\ns"


def test_every_run_that_an_earlier_document_has_is_cut(documents):
    draw = random.Random(11)
    vocabulary = [f"{i} " + "word " * (i % 7) for i in range(9)]
    rows = [(i, "\n".join(x.strip() for x in draw.choices(vocabulary, k=draw.randrange(1, 16)))) for i in range(150)]
    found = {r[0]: r[1] for r in kept(documents(rows))}
    texts = [t.split("\n") for _, t in rows]
    cut = 0
    for d, own in enumerate(texts):
        gone = set()
        for before in texts[:d]:
            for lo in range(len(own)):
                for hi in range(lo + 2, len(own) + 1):
                    if sum(map(len, own[lo:hi])) >= linededup.BLOCK and any(
                        before[k : k + hi - lo] == own[lo:hi] for k in range(len(before))
                    ):
                        gone.update(range(lo, hi))
        cut += len(gone)
        assert found[d] == "\n".join(x for j, x in enumerate(own) if j not in gone)
    assert cut > 200


def test_many_copies_of_one_line_are_cut_in_tables_of_any_size(documents):
    line = "the only line of a text that very many documents are made of"
    for n in (20, 60):
        left = linededup.drop_blocks(documents([(i, line) for i in range(n)]))
        assert [r.doc_id for r in left.collect()] == [0]


def test_lines_of_a_hot_first_holder_are_sent_once_a_block_of_partners(documents, monkeypatch):
    monkeypatch.setattr(linededup, "PARTNERS", 16)
    long = [f"line number {i} of the boilerplate that everyone takes from" for i in range(300)]
    rows = [(0, "\n".join(long))]
    rows += [(i, "\n".join([f"own {i}", long[i], long[i + 1], long[i + 2], "end"])) for i in range(1, 201)]
    docs = documents(rows)
    met = linededup.meetings(linededup.hashed_lines(docs)).selectExpr("first.doc_id AS first", "place", "size(lines) AS n")
    sent = [(r.first, r.place is None, r.n) for r in met.collect()]
    assert sum(n for _, first, n in sent if first) <= 2 * (300 * -(-200 // 16) + 5 * 200)
    assert sum(1 for f, first, _ in sent if f == 0 and not first) == 200
    found = {r[0]: r[1] for r in kept(docs)}
    assert found[0] == rows[0][1] and [found[i] for i in range(1, 201)] == [f"own {i}\nend" for i in range(1, 201)]
