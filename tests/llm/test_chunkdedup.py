import random

import numpy as np
from odd_rows import ODD

from riskwindow.llm import chunkdedup


def _words(draw, n):
    return " ".join("".join(draw.choices("abcdefghijé漢", k=draw.randrange(2, 9))) for _ in range(n))


def kept(docs):
    return [
        (r.row.doc_id, r.kept, [tuple(x) for x in r.spans], r.n_chunks) for r in chunkdedup.without_repeats(docs).collect()
    ]


def test_hash_rolls_over_the_last_bytes_only():
    raw = np.frombuffer(random.Random(1).randbytes(300), dtype=np.uint8)
    h = chunkdedup.rolled(raw)
    for i in (0, 5, 40, 299):
        window = raw[max(0, i - chunkdedup.WINDOW + 1) : i + 1][::-1]
        assert h[i] == sum(int(chunkdedup.GEAR[b]) << j for j, b in enumerate(window)) % 2**32


def test_chunks_cover_the_text_and_do_not_depend_on_their_neighbours():
    draw = random.Random(2)
    texts = [_words(draw, n) for n in (0, 1, 5, 300, 40)] + [None, "x" * 1000, "漢" * 500, "🙂" * 99]
    together, alone = chunkdedup.cut(texts), [chunkdedup.cut([t])[0] for t in texts]
    assert together == alone
    for text, (ends, digests) in zip(texts, together):
        assert (ends[-1] if ends else 0) == len(text or "") and len(ends) == len(digests) == len(set(ends))
        sizes = [len((text or "")[a:b].encode()) for a, b in zip([0, *ends], ends)]
        assert all(s <= chunkdedup.LONGEST for s in sizes) and all(s > chunkdedup.SHORTEST - 4 for s in sizes[:-1])


def test_ends_come_back_after_an_insertion():
    text = _words(random.Random(3), 600)
    (_, before), (_, after) = chunkdedup.cut([text, text[:500] + "inserted words" + text[500:]])
    assert len(set(before) - set(after)) <= 4


def test_repeated_passages_leave_later_documents(documents):
    draw = random.Random(4)
    passage = _words(draw, 120)
    own = {i: (_words(draw, 40), _words(draw, 40)) for i in range(5)}
    rows = [(i, f"{a} {passage} {b}") for i, (a, b) in own.items()] + [(90, _words(draw, 200))]
    found = {r[0]: r for r in kept(documents(rows, clash=True))}
    assert found[0][1] == rows[0][1] and found[90][1] == rows[-1][1]
    for i in range(1, 5):
        (start, end), = found[i][2]
        text = rows[i][1]
        assert text[start:end] in passage and end - start > len(passage) - 2 * chunkdedup.LONGEST
        assert found[i][1] == text[:start] + text[end:]


def test_copies_inside_a_document_and_whole_copies(documents):
    passage = _words(random.Random(6), 150)
    found = {r[0]: r for r in kept(documents([(1, passage + passage), (2, passage), (3, passage)]))}
    assert len(passage) <= len(found[1][1]) < len(passage) + 2 * chunkdedup.LONGEST
    assert found[3][2] == [(0, len(passage))] or len(found[3][1]) < 2 * chunkdedup.LONGEST


def test_short_repeats_stay(documents):
    draw = random.Random(8)
    rows = [(i, _words(draw, 60) + " Licence notice of forty characters or so. " + _words(draw, 60)) for i in range(30)]
    assert all(spans == [] for _, _, spans, _ in kept(documents(rows)))


def test_odd_rows(documents):
    passage = _words(random.Random(9), 100)
    rows = [*ODD, (6, passage), (6, passage), (None, passage), (7, passage)]
    found = kept(documents(rows, clash=True))
    said = sorted((str(i), str(t), n > 0) for i, t, _, n in found)
    assert said == sorted(
        [(str(i), str(t), bool(t)) for i, t in ODD] + [("6", passage, True)] * 2 + [("7", "", True), ("None", "", True)]
    )


def test_no_rows(documents):
    assert kept(documents([])) == [] and chunkdedup.repeated_spans(documents([])).count() == 0


def plain_chunks(text):
    """Chunks byte by byte: (start, end) in code points and the bytes; the hash over all bytes so far."""
    raw = (text or "").encode()
    out, start, h = [], 0, 0
    for i, b in enumerate(raw):
        h = (2 * h + int(chunkdedup.GEAR[b])) % 2**32
        if i + 1 - start < chunkdedup.SHORTEST:
            continue
        window = sum(int(chunkdedup.GEAR[c]) << j for j, c in enumerate(raw[max(0, i - 15) : i + 1][::-1])) % 2**32
        whole = i + 1 == len(raw) or raw[i + 1] & 0xC0 != 0x80
        end = None
        if whole and window >> 28 == 0:
            end = i + 1
        elif i + 1 - start == chunkdedup.LONGEST:
            end = i + 1
            while end < len(raw) and raw[end] & 0xC0 == 0x80:
                end -= 1
        if end:
            out.append((start, end))
            start = end
    if start < len(raw):
        out.append((start, len(raw)))
    point = lambda at: len(raw[:at].decode())
    return [(point(a), point(b), raw[a:b]) for a, b in out]


def plain_spans(rows):
    """First holders by a dictionary, runs by a loop; no digests, no bitmap."""
    first = {}
    for i, text in rows:
        for _, _, raw in plain_chunks(text):
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, text in rows:
        seen, runs, hits = set(), [], 0
        for a, b, raw in plain_chunks(text):
            if first[raw] < i or raw in seen:
                hits += 1
                if runs and runs[-1][1] == a:
                    runs[-1] = (runs[-1][0], b, runs[-1][2] + 1)
                else:
                    runs.append((a, b, 1))
            seen.add(raw)
        long = [r for r in runs if r[1] - r[0] >= chunkdedup.RUN]
        out.append((i, len(plain_chunks(text)), hits, sum(r[2] for r in long), [r[:2] for r in long]))
    return out


def test_equals_a_plain_chunker_and_first_holders(documents):
    draw = random.Random(11)
    passages = [_words(draw, n) for n in (8, 15, 30, 60, 150)]
    rows = []
    for i in range(70):
        parts = [draw.choice([_words(draw, draw.randrange(1, 30)), draw.choice(passages)]) for _ in range(draw.randrange(5))]
        rows.append((i, " ".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1] * 2), (202, "a" * 700), (203, "a" * 700), (204, "漢" * 300 + passages[3])]
    found = sorted(
        (r.doc_id, r.n_chunks, r.n_repeated, r.n_cut, [tuple(x) for x in r.spans])
        for r in chunkdedup.repeated_spans(documents(rows)).collect()
    )
    assert found == plain_spans(rows)
    assert any(r[2] > r[3] for r in found) and sum(bool(r[4]) for r in found) > 20
