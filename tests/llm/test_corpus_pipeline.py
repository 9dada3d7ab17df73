"""The pipeline against plain Python over the smallest tables."""

import hashlib
import os

import duckdb
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from test_simhash import plain_components, plain_fingerprint

import __spark_entry__ as entry
import corpus_pipeline
from riskwindow.llm import bpe, common, decontam, langid, linededup

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def _plain_lines(rows):
    """Line dedup with a dictionary of first holders."""
    import xxhash

    digest = lambda s: xxhash.xxh64_intdigest(s.encode())
    lines = {i: [x.strip(" \t\r") for x in t.split("\n")] for i, t in rows if t}
    held = {}
    for i, own in lines.items():
        full = [x for x in own if x]
        held[i] = {(True, x) for x in full if len(x) >= linededup.LONG} | {
            (False, x) for x in full if linededup.LINE <= len(x) < linededup.LONG
        } | {(True, (x, y)) for x, y in zip(full, full[1:]) if len(x) + len(y) >= linededup.PAIR}
    first, times = {}, {}
    for i in sorted(held):
        for _, x in held[i]:
            first.setdefault(x, i)
            times[x] = times.get(x, 0) + 1
    rare = max(linededup.RARE, int(linededup.RARE_SHARE * len(lines)))
    out = []
    for i, text in rows:
        partners = {first[x] for always, x in held.get(i, ()) if first[x] != i and (always or times[x] <= rare)}
        gone = set()
        for k in partners:
            a, b = ([digest(x) for x in lines[j]] for j in (k, i))
            for lo, hi in linededup.blocks(a, b, [len(x) for x in lines[i]]):
                gone.update(range(lo, hi + 1))
        kept = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone) if gone else text
        if not gone or kept.strip():
            out.append((i, kept))
    return out


def test_equals_plain_python(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    model = langid.Model(langid.dictionaries(common.table(spark, FOLDER, "documents")))
    rows = [(i, t) for i, t in rows if (p := model.predict(t))[0] != "und" and p[2] >= langid.MARGIN]
    rows = _plain_lines(rows)
    roots = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    rows = [r for r, root in zip(rows, roots) if r[0] == root]

    words = decontam._Words()

    def template(text):
        _, code, kind, value = decontam.templates([text], words)
        return code.tolist()

    wanted = set()
    for _, t in items:
        own = template(t)
        n = min(decontam.COVER, len(own))
        wanted |= {tuple(own[j : j + n]) for j in range(len(own) - n + 1)} if n >= decontam.LEAST else set()
    sizes = {len(x) for x in wanted}
    clean = []
    for i, t in rows:
        own = template(t)
        if not any(tuple(own[j : j + n]) in wanted for n in sizes for j in range(len(own) - n + 1)):
            clean.append((i, t))
    words = bpe.vocabulary()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.rank, special_tokens={})
    expected = []
    for i, t in clean:
        ids = library.encode_ordinary(t)
        expected.append(
            (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        )
    found = sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert found == sorted(expected)
    assert 0 < len(found) < 200


def test_stages_return_the_columns_of_documents(spark):
    docs = common.table(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), FOLDER).schema.simpleString() == docs.schema.simpleString()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", ["op1_kdtree_topk", "op4_warc_revisits"])
def test_queries_equal_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    expected = connection.execute(entry.oracle_sql()[name]).df()
    found = entry.queries()[name](spark, FOLDER).toPandas()
    columns = sorted(expected.columns)
    assert columns == sorted(found.columns)
    said = lambda f: sorted(tuple("" if pd.isna(v) else str(v) for v in r) for r in f[columns].astype(object).itertuples(index=False))
    assert [tuple(v.removesuffix(".0") for v in r) for r in said(found)] == [tuple(v.removesuffix(".0") for v in r) for r in said(expected)]


def test_every_operator_has_a_query_and_language_id_is_right_on_texts_not_learnt(spark):
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    found = names["op3_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    lang = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    own = found[found.held_out]
    assert len(found) == 1000 and (own.lang_pred == own.doc_id.map(lang)).mean() > 0.97
