import hashlib
import random
import re

import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from riskwindow.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    numbers = [int(c) for c in reversed(digits)]
    return sum(n if i % 2 == 0 else n * 2 - 9 * (n > 4) for i, n in enumerate(numbers)) % 10 == 0


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    found = [
        (m.start(), pii.KINDS.index(k), f"{k}:{m.start()}:{m.end()}")
        for k in pii.KINDS
        for m in re.finditer(PLAIN[k], text or "")
        if passes(k, m.group())
    ]
    return [x[2] for x in sorted(found)]


@pytest.fixture
def run(documents):
    def build(rows):
        frame = pii.spans(documents(rows, clash=True))
        said = "transform({}, x -> concat(x.kind, ':', x.start, ':', x.end))"
        return [(r[0], list(r[1]), list(r[2])) for r in frame.selectExpr(
            "doc_id", said.format("base"), said.format("spans")).collect()]

    return build


def test_base_spans_equal_plain_patterns(run):
    draw = random.Random(12)
    parts = ["a.b@c.de", "@", "x_y@z", ".com", "1.2.3.4", ".5", "300.1.1.1", "0255.01.1.1", "4111111111111111", "4111 1111-1111 1111",
             "  ", " ", "-", "5", "12", "+1 (555) 123-4567", "+", "(", ")", "9876543210", "é", "漢", "🙂", "a", "_", "\n", "--", "%", "+49 30 1234567"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(12))) for _ in range(3000)]
    texts += ["a@b.c.d_x@e.f", "1.2.3.4.5.6.7.8", "1" * 30_000, "x" * 50_000 + "@y.z", "1 2 " * 8000, "4111111111111111 27.65.93.188"]
    for doc_id, found, spans in run(list(enumerate(texts))):
        assert found == base(texts[doc_id]), texts[doc_id][:200]
        assert set(found) <= set(spans)


def test_very_many_spans_in_one_text(run):
    text = "write to a.b@c.de now " * 3000
    (_, found, spans), = run([(1, text)])
    assert found == spans == base(text)


def plain_overlaps(strict, loose, accepted):
    """What stays of candidates (kind, start, end, base), by comparing all pairs."""
    cross = lambda x, y: x[1] < y[2] and y[1] < x[2]
    loose = [x for x in loose if not any(y[3] and cross(x, y) for y in strict)]
    found = [x for x in strict + loose if x[3] or accepted(x)]
    return sorted(
        (x[1], pii.KINDS.index(x[0]), x[2])
        for x in found
        if x[3] or not any(y[0] == x[0] and y != x and cross(x, y) and (y[3] or y[2] - y[1] > x[2] - x[1]) for y in found)
    )


def test_overlaps_equal_all_pairs(spark, documents):
    """Candidates as found, a classifier that takes everything: the same spans as by comparing all pairs."""
    draw = random.Random(8)
    parts = ["4111111111111111", "4111 1111-1111 1111", "555-123-4567", "(555) 123-4567", "+1 555 123 4567", "a@b.co",
             "a [at] b.co", "x(at)y(dot)de", "1.2.3.4", "1.2.3.400", "5500005555555559", "12 ", "-", " ", " or ", "+", "4000000000000"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(1, 60))) for _ in range(400)]
    found = pii.candidates(documents(list(enumerate(texts)))).collect()
    kept = {r.doc_id: r.spans for r in pii.spans(documents(list(enumerate(texts)))).collect()}
    fitted = {r.doc_id: {(x.kind, x.start, x.end) for x in r.spans} for r in pii.spans(documents(list(enumerate(texts)))).collect()}
    seen = 0
    for row in found:
        own = [(x.kind, x.start, x.end, x.base) for x in row.found]
        strict = [x for x, y in zip(own, row.found) if not y.loose]
        loose = [x for x, y in zip(own, row.found) if y.loose]
        assert not any(y[3] and x[1] < y[2] and y[1] < x[2] for x in loose for y in strict)
        # Every span that stays beats all that overlap it and are not there.
        every = plain_overlaps(strict, loose, lambda x: x[:3] in fitted[row.doc_id])
        assert [(x.start, x.nth, x.end) for x in kept[row.doc_id]] == every
        seen += sum(not x[3] for x in own)
    assert seen > 500


def test_work_grows_with_the_spans_of_a_text(run):
    """Added spans, failed matches and cards inside runs of numbers, tens of thousands in one text."""
    text = "".join(f"call 555-{200 + i % 700}-{1000 + i % 9000} or {4000000000000 + i * 7919} " for i in range(20_000))
    (_, found, spans), = run([(1, text)])
    assert set(found) == set(base(text)) and len(spans) >= 19_000
    text = "4000000000006 " * 20_000
    (_, found, _), = run([(1, text)])
    assert found == base(text)


def test_adds_a_card_that_the_plain_pattern_runs_over(run):
    draw = random.Random(2)

    def card():
        while True:
            digits = "4" + "".join(draw.choices("0123456789", k=15))
            if luhn(digits):
                return digits

    rows = [(i, f"number {card()} of the card") for i in range(40)]
    rows += [(100 + i, f'token = "{draw.getrandbits(90):x}9{draw.randrange(10**14)}f"') for i in range(20)]
    # A card and an address beside it are one match of the card pattern, which fails.
    hit, address = card(), "27.65.93.188"
    while luhn(hit + "27"):
        hit = card()
    text = f"number {hit} {address} of the card"
    found = {i: (b, s) for i, b, s in run([*rows, (200, text)])}
    assert found[200] == ([f"ip:24:{24 + len(address)}"], ["card:7:23", f"ip:24:{24 + len(address)}"])
    assert all(s == b for i, (b, s) in found.items() if i < 200)


def test_odd_rows(run):
    found = run([*ODD, (9, "a@b.co"), (9, "a@b.co")])
    assert len(found) == len(ODD) + 2
    assert sorted((str(i), tuple(s)) for i, _, s in found if s) == [("9", ("email:0:6",))] * 2


def test_no_rows_and_no_candidates(run):
    assert run([]) == []
    assert run([(1, "nothing here")]) == [(1, [], [])]


def test_maximisation_tells_good_labelers_from_bad_ones(spark):
    draw = random.Random(1)
    rows = []
    for _ in range(2000):
        true = draw.random() < 0.3
        votes = [(1 if (draw.random() < p) == true else -1) for p in (0.95, 0.9, 0.55)] + [0]
        rows.append(("ip", votes))
    model = pii.reliabilities(spark.createDataFrame(rows, "kind string, votes array<int>")).first().model
    assert abs(model.prior - 0.3) < 0.06
    assert model.hit[0] > 0.85 and model.clear[0] > 0.85 and model.hit[2] < 0.7
    assert abs(model.hit[3] - 0.8) < 1e-9


def test_maximisation_equals_plain_python(spark):
    patterns = {(1, 1, 0, -1): 5, (-1, 1, 1, 0): 3, (-1, -1, 0, -1): 9}
    rows = [("card", list(v)) for v, n in patterns.items() for _ in range(n)]
    model = pii.reliabilities(spark.createDataFrame(rows, "kind string, votes array<int>")).first().model
    prior, hit, clear = 0.5, [0.8] * 4, [0.8] * 4
    for _ in range(pii.ROUNDS):
        p = {}
        for v in patterns:
            yes, no = prior, 1 - prior
            for k, x in enumerate(v):
                yes *= {1: hit[k], -1: 1 - hit[k], 0: 1}[x]
                no *= {-1: clear[k], 1: 1 - clear[k], 0: 1}[x]
            p[v] = yes / (yes + no)
        prior = (1 + sum(n * p[v] for v, n in patterns.items())) / (2 + sum(patterns.values()))
        rate = lambda k, vote, w: (4 + sum(n * w(v) for v, n in patterns.items() if v[k] == vote)) / (
            5 + sum(n * w(v) for v, n in patterns.items() if v[k]))
        hit = [rate(k, 1, lambda v: p[v]) for k in range(4)]
        clear = [rate(k, -1, lambda v: 1 - p[v]) for k in range(4)]
    assert abs(model.prior - prior) < 1e-9
    assert all(abs(a - b) < 1e-9 for a, b in zip([*model.hit, *model.clear], [*hit, *clear]))


def test_plan_has_no_python(documents):
    plan = pii.spans(documents([(1, "a@b.co")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_query_digests(spark, tmp_path, documents):
    documents([(1, "mail a@b.co and 1.2.3.4"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in pii.op5_pii(spark, str(tmp_path)).collect()}
    assert found[1].base_sha256 == hashlib.sha256(b"email:5:11,ip:16:23").hexdigest()
    assert (found[1].n_email, found[1].n_ip, found[1].n_card, found[1].n_phone) == (1, 1, 0, 0)
    assert (found[2].spans, found[2].base_sha256) == ("", hashlib.sha256(b"").hexdigest())
