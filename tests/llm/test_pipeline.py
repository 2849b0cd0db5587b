"""The corpus pipeline, stage by stage, against what each stage promises."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
from marquee.llm import decontam, jaccard, rules
from marquee.llm.common import materialise


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialise(stage(spark, tables[-1], sf_dir), f"test-{name}"))
    assert all(t.columns == columns for t in tables[:-1])
    ids = [{r.doc_id for r in t.select("doc_id").collect()} for t in tables]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r.doc_id for r in rules.quality_rules(docs, labels).filter("kept").collect()}
    assert ids[1] == kept
    groups = jaccard.ngram_jaccard_components(tables[1], 5, 80).collect()
    assert ids[2] == {r.component_id for r in groups}
    assert ids[3] == ids[2]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    items = [decontam.normal(b.text) for b in bench]
    texts = {r.doc_id: decontam.normal(r.text) for r in tables[3].collect()}
    for d, t in texts.items():
        if any(i and i in t for i in items):
            assert d not in ids[4]
    assert all(r.round_trip for r in tables[5].select("round_trip").collect())
    assert ids[5] == ids[4]


def test_entry_survives_without_the_subpackage(monkeypatch):
    import sys

    import __spark_entry__ as entry
    assert "op1_ngram_jaccard_join" in entry.queries() and "pipeline" in entry.queries()
    monkeypatch.setitem(sys.modules, "marquee.llm.queries", None)
    left = entry.queries()
    assert "movies_flat" in left and not any(k.startswith("op1_") or k == "pipeline" for k in left)
    assert "op1_ngram_jaccard_join" not in entry.oracle_sql()


def word_repeats_cut(texts, n_bytes, n_words):
    """Texts without the bytes of repeated ``n_bytes`` strings and of repeated ``n_words`` passages."""
    raw = [t.encode() for t in texts]
    words = [[(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)] for b in raw]
    strings = Counter(b[i:i + n_bytes] for b in raw for i in range(len(b) - n_bytes + 1))
    passages = Counter(tuple(x[2] for x in w[i:i + n_words]) for w in words for i in range(len(w) - n_words + 1))
    out = []
    for b, w in zip(raw, words):
        gone = bytearray(len(b))
        for i in range(len(b) - n_bytes + 1):
            if strings[b[i:i + n_bytes]] > 1:
                gone[i:i + n_bytes] = b"\1" * n_bytes
        for i in range(len(w) - n_words + 1):
            if passages[tuple(x[2] for x in w[i:i + n_words])] > 1:
                a, e = w[i][0], w[i + n_words - 1][1]
                gone[a:e] = b"\1" * (e - a)
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"))
    return out


def test_repeated_passages_of_over_50_words_go(spark):
    """51 words of under 400 bytes are cut, 50 words stay."""
    r = random.Random(5)
    def some(n):
        return [f"{r.choice('bdfgklmn')}{r.choice('aeiou')}{r.randrange(1000)}" for _ in range(n)]
    def text(passage):
        return " ".join([*some(40), *passage, *some(30)])
    p51, p50, tiny, long = some(51), some(50), [r.choice("abcdefgh") for _ in range(51)], ["x" * 450]
    assert len(" ".join(p51)) < 400
    rows = [(i, text(p)) for i, p in enumerate([p51, p50, tiny, long] * 2)]
    rows.append((8, " ".join(some(20)) + "\n" + "\t ".join(p51) + " end"))
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars int")
    got = {x.doc_id: x for x in corpus_pipeline.repeat_stage(spark, docs, "").collect()}
    want = word_repeats_cut([t for _, t in rows], 400, 51)
    assert {i: x.text for i, x in got.items()} == dict(enumerate(want))
    assert all(x.n_chars == len(x.text) for x in got.values())
    assert got[1].text == rows[1][1] and len(got[0].text) < len(rows[0][1]) and " ".join(tiny) not in got[2].text


def test_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: a row's verdict does not touch other rows, one row per group stays."""
    r = random.Random(6)
    def some(n):
        return " ".join(f"w{r.randrange(100000)}" for _ in range(n))
    clean, clean2, clean3, junk, item = some(80), some(80), some(80), "spam " * 60, some(30)
    leak = some(50) + " " + item + " " + some(20)
    one = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{one}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{one}/benchmark.parquet")
    def docs(rows):
        return spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    def left(stage, rows):
        out = stage(spark, docs(rows), one)
        assert out.columns == ["doc_id", "text", "lang"]
        return Counter((x.doc_id, x.text) for x in out.collect())
    rows = [(None, clean), (None, junk), (7, clean2), (7, junk), (8, clean3), (8, clean3)]
    assert left(corpus_pipeline.quality_stage, rows) == Counter(x for x in rows if x[1] != junk)
    rows = [(None, clean), (None, leak), (7, clean2), (7, leak), (8, clean3), (8, clean3), (9, None), (None, None)]
    assert left(corpus_pipeline.decontamination_stage, rows) == Counter(x for x in rows if x[1] != leak)
    near = clean + " end"
    rows = [(None, clean), (None, near), (None, clean),       # a group without ids
            (5, clean2), (5, clean2), (5, clean2 + " end"),   # one id throughout
            (3, clean3), (4, clean3 + " end"), (4, junk), (None, clean3),
            (5, leak), (6, ""), (6, None)]
    got = left(corpus_pipeline.near_duplicate_stage, rows)
    assert sum(got[None, t] for t in (clean, near)) == 1
    assert got[5, clean2] + got[5, clean2 + " end"] == 1
    assert got[3, clean3] == got[4, junk] == got[5, leak] == got[6, ""] == got[6, None] == 1
    assert sum(got.values()) == 7
