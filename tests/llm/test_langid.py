import random

import zstandard
from odd_rows import ODD

from riskwindow.llm import langid

PARTS = {
    "xx": "ba be bi bo bu da de di do du".split(),
    "yy": "zor ket mol wug pex lin rud sof tam nik".split(),
}


def _text(draw, lang, n=60):
    return " ".join("".join(draw.choices(PARTS[lang], k=draw.randrange(1, 4))) for _ in range(n))


def _rows(n):
    draw = random.Random(8)
    return [(i, _text(draw, "xx" if i % 3 else "yy"), "xx" if i % 3 else "yy") for i in range(n)]


def test_finds_the_language_of_texts_that_were_not_learnt(documents):
    learnt, other = _rows(90)[:60], _rows(90)[60:]
    content = langid.dictionaries(documents(learnt))
    assert sorted(content) == ["xx", "yy"] and all(0 < len(c) <= langid.DICTIONARY + 2 for c in content.values())
    model = langid.Model(content)
    for _, text, lang in other:
        found, score, margin = model.predict(text)
        assert found == lang and 0.5 < score <= 1 and margin >= langid.MARGIN
    # Marks, digits and capitals count for nothing.
    assert model.predict(other[0][1].upper().replace(" ", "!! 1 "))[0] == other[0][2]


def test_size_is_that_of_all_blocks_of_the_whole_text(documents):
    content = langid.dictionaries(documents(_rows(30)))
    model = langid.Model(content)
    text = _text(random.Random(1), "xx", 3000)
    raw = langid.normalise(text).encode()
    for size, own in zip(model.sizes(text), content.values()):
        words = zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=words, write_content_size=False)
        parts = [raw[i : i + langid.BLOCK] for i in range(0, len(raw), langid.BLOCK)]
        assert len(parts) > 2 and abs(size - sum(len(packer.compress(p)) for p in parts)) <= 8 * len(parts)


def test_short_texts_are_told_apart(documents):
    model = langid.Model(langid.dictionaries(documents(_rows(60))))
    draw = random.Random(3)
    for lang in PARTS:
        found = [model.predict(_text(draw, lang, 5)) for _ in range(60)]
        assert sum(f[0] == lang for f in found) > 0.9 * len(found)
        assert all(0 <= f[1] <= 1 and 0 <= f[2] <= 1 for f in found)
    assert model.predict("é")[0] in PARTS


def test_texts_without_letters_are_undetermined(documents):
    content = langid.dictionaries(documents(_rows(30)))
    rows = [*ODD, (8, "12 34 ²!")]
    frame = documents(rows).select("doc_id", "text")
    found = langid.classify(frame, content).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id in (1, 2, 3, 8):
            assert (row.lang_pred, row.score, row.accepted) == ("und", 0.0, False)
        assert 0 <= row.score <= 1


def test_copies_do_not_fill_the_sample(documents):
    rows = _rows(40) + [(1000 + i, "copy of a text", "xx") for i in range(300)]
    content = langid.dictionaries(documents(rows), sample=100)
    assert content["xx"] and content["yy"]


def test_nothing_learnt_and_no_rows(documents):
    docs = documents([(1, "a text", None), (2, "b", None)])
    assert langid.dictionaries(docs) == {} == langid.dictionaries(documents([]))
    assert {r.lang_pred for r in langid.classify(docs.select("doc_id", "text"), {}).collect()} == {"und"}
    assert langid.keep_accepted(documents([])).count() == 0


def test_rejected_rows_go_and_others_keep_all_columns(documents):
    docs = documents([*_rows(40), (90, None, "xx"), (91, "1 2 3", "yy")], clash=True)
    kept = langid.keep_accepted(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(40))


def test_copies_do_not_shrink_the_sample(documents):
    different = ["only" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    rows = [(i, "many copies of one text", "en") for i in range(2000)]
    rows += [(3000 + i, word, "en") for i, word in enumerate(different)]
    learnt = langid.dictionaries(documents(rows), sample=100)["en"].decode().split()
    assert set(different) <= set(learnt)


def test_combining_marks_belong_to_their_words():
    assert langid.normalise("हिन्दी में 12 शब्द_हैं!") == "हिन्दी में शब्द हैं "
    assert langid.normalise("Café au lait") == "café au lait"
