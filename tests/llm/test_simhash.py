import random
import re

import numpy as np
import xxhash
from odd_rows import ODD

from riskwindow.llm import simhash


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """prints: list of (doc_id, fingerprint); smallest doc_id by place in the list."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprint_equals_plain_one():
    texts = ["", "A", "Ä b\x0bC", "one two three four ONE two three", " ".join(map(str, range(70_000 // 50)))]
    for text in texts:
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_every_close_pair_meets_in_some_table():
    draw = random.Random(5)
    for tables in (simhash.covering(3, tuple(range(64))),):
        for _ in range(20_000):
            difference = sum(1 << b for b in draw.sample(range(64), 3))
            assert any(not difference & mask for mask in tables)
    for mask, inner in simhash._second(3):
        ignored = [b for b in range(64) if not mask >> b & 1]
        assert max(64 - m.bit_count() for m in inner) <= 16
        for _ in range(500):
            difference = sum(1 << b for b in draw.sample(ignored, 3))
            assert any(not difference & m for m in inner)


def test_forest_spans_the_links_of_a_bucket():
    draw = random.Random(1)
    values = np.array([draw.getrandbits(7) for _ in range(40)], dtype=np.int64)
    values = np.unique(values)
    a, b = simhash.forest(values, 1)
    assert len(a) <= len(values) - 1


def _chain(n):
    """Fingerprints that are linked one after the other, and some that stand alone."""
    draw = random.Random(3)
    start, out = draw.getrandbits(64), []
    for i in range(n):
        out.append(start)
        for b in draw.sample(range(64), 3):
            start ^= 1 << b
    return out + [draw.getrandbits(64) for _ in range(20)]


def test_components_of_links_equal_brute_force(spark):
    values = list(dict.fromkeys(_chain(60)))
    expected = plain_components(list(enumerate(values)))
    rows = [(v - 2**64 if v >> 63 else v,) for v in values]
    frame = spark.createDataFrame(rows, "fingerprint long")
    for bucket in (4096, 1):  # the second deals every bucket out again
        parts = simhash.components(simhash.links(frame, bucket=bucket))
        roots = {r["node"]: r["root"] for r in parts.collect()}
        by_root = {}
        for (v,), own in zip(rows, expected):
            by_root.setdefault(roots.get(v, ("alone", v)), set()).add(own)
        assert all(len(x) == 1 for x in by_root.values())
        assert len(by_root) == len(set(expected))


def test_clusters_of_texts(documents):
    words = [f"w{i}" for i in range(300)]
    near = words.copy()
    near[150] = "other"
    rows = [(7, " ".join(words)), (5, " ".join(near)), (9, " ".join(words)), (3, "alone " * 9), *ODD]
    found = simhash.clusters(documents(rows, clash=True)).collect()
    assert len(found) == len(rows)
    plain = [(i, plain_fingerprint(t)) for i, t in rows]
    expected = sorted(
        (str(i), p, str(c)) for (i, p), c in zip(plain, plain_components(plain))
    )
    assert expected == sorted((str(r.doc_id), r.fingerprint % 2**64, str(r.component_id)) for r in found)


def test_keep_one_keeps_all_columns_and_one_row_of_each_component(documents):
    rows = [(2, "a b c d"), (1, "a b c d"), (1, "a b c d"), (8, "other words here"), *ODD]
    docs = documents(rows, clash=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == ["1", "1", "4", "8", "None"]  # the second 1 is the blank text of row 1


def test_no_rows(documents):
    assert simhash.clusters(documents([])).count() == 0
    assert simhash.keep_one(documents([])).count() == 0
