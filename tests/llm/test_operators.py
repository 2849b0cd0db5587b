"""Corpus operators against brute force on small tables: nulls, empty and
long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import (decontam, jaccard, langid, licenses, quality_bayes, rules, sentencepiece, suffix_dedup,
                         tokens, urls)

SPACED = "[^\x20\x09-\x0D]+"


def lower(s):
    return s.translate({i: i + 32 for i in range(65, 91)})


def corpus(seed=1, n=70):
    """Texts with copies, near copies, shared passages and odd rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgé") for _ in range(r.randint(1, 7))) for _ in range(400)]
    words = lambda k: [r.choice(vocab) for _ in range(k)]
    passage, base = words(40), words(90)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            w = words(r.randint(0, 120))
        elif kind == 1:
            w = words(20) + passage + words(r.randint(0, 30))
        elif kind in (2, 3):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocab)
        elif kind == 4:
            w = list(passage[:r.randint(1, 6)])
        else:
            w = words(30) * 3
        rows.append((i, r.choice([" ", "  ", "\n"]).join(w).title() if i % 5 == 0 else " ".join(w)))
    rows += [(1000, None), (None, None), (None, " ".join(base)), (1001, ""), (1002, " \t\n"), (3, rows[3][1]),
             (1003, "one"), (1004, "ONE"), (1005, "x" * 5000), (1006, " ".join(words(6000)))]
    return rows


def frame(spark, rows):
    """Extra columns whose names clash with those that operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return (df.withColumn("n", F.lit("n")).withColumn("node", F.lit(1)).withColumn("key", F.lit(None).cast("string"))
            .withColumn("score", F.lit(2)).withColumn("source", F.lit("s")).withColumn("lang", F.lit(None).cast("string")))


def empty(spark):
    return frame(spark, [(1, "a")]).limit(0)


def by_id(rows):
    return sorted(rows, key=lambda x: tuple((v is not None, v if v is not None else 0) for v in x))


# ------------------------------------------------------------------ 1 Jaccard
def jaccard_brute(rows, k, pct):
    sets = []
    for _, t in rows:
        w = re.findall(SPACED, lower(t or ""))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k
                    else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= pct * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return by_id([(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)])


@pytest.mark.parametrize("pct,unit", [(85, 1024), (60, 4)])
def test_jaccard_components(spark, pct, unit):
    rows = corpus()
    got = jaccard.ngram_jaccard_components(frame(spark, rows), 4, pct, max_unit=unit).collect()
    assert by_id(map(tuple, got)) == jaccard_brute(rows, 4, pct)


def test_signature_tree_loses_no_link():
    r = random.Random(5)
    import numpy as np
    base = r.sample(range(10**6), 60)
    sets = [np.unique(np.array([x if r.random() > 0.06 else r.randrange(10**6) for x in base] + [7])) for _ in range(90)]
    found = jaccard.linked(sets, 80)
    root = list(range(90))
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in found:
        assert 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
        root[find(a)] = find(b)
    for a, b in itertools.combinations(range(90), 2):
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b])):
            assert find(a) == find(b)


# ------------------------------------------------------------------- 2, 4 quality
def labelled(spark, rows):
    return spark.createDataFrame([(d, 0 if "#" in (t or "") else 1) for d, t in rows if d is not None] + [(None, 1), (5, None)],
                                 "doc_id long, quality int").withColumn("toxic", F.lit(None).cast("int"))


def quality_rows():
    r = random.Random(2)
    rows = [(i, " ".join("w%d" % r.randrange(500) + ("###" if i % 4 == 0 else "") for _ in range(80))) for i in range(600)]
    return rows + [(9000, None), (9001, ""), (None, "a b"), (3, rows[3][1])]


def rule_brute(t):
    t = t or ""
    w = re.findall(SPACED, t)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    earlier, dup = set(), 0
    for line in t.split("\n"):
        if re.search(SPACED, line):
            dup += line in earlier
            earlier.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))


def test_quality_rules(spark):
    rows = quality_rows() + [(7000 + i, t) for i, (_, t) in enumerate(corpus(4))] + [(8000, "a b c\n\na b c\n \n a b c|\nd")]
    out = rules.quality_rules(frame(spark, rows), labelled(spark, rows)).collect()
    assert len(out) == len(rows)
    want = Counter((d, rule_brute(t)) for d, t in rows)
    assert want == Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in out)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.failed_rules)
        if r.doc_id is not None and r.doc_id < 600:
            assert r.kept == (r.doc_id % 4 != 0)


def test_binomial_bound():
    from math import comb
    for n, rate, level in ((50, 0.1, 0.05), (400, 0.02, 0.01), (10, 0.02, 0.05)):
        k = rules.most_rejections(n, rate, level)
        cdf = lambda m: sum(comb(n, j) * rate**j * (1 - rate)**(n - j) for j in range(m + 1))  # noqa: E731, B023
        assert (k < 0 or cdf(k) <= level) and cdf(k + 1) > level


def test_bayes_scores(spark):
    rows = quality_rows()
    out = quality_bayes.quality_scores(frame(spark, rows), labelled(spark, rows)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    good = [r.kept for r in out if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 4]
    bad = [r.kept for r in out if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 4 == 0]
    assert all(good) and not any(bad)


def test_shrinkage_strength():
    # no spread beyond chance: the parent's share; large spread: little shrinkage
    assert quality_bayes.strength(10, 1000.0, 1e5, 1.0, 0.5) == 1e6
    assert quality_bayes.strength(10, 1000.0, 1e5, 200.0, 0.5) < 5


# --------------------------------------------------------------- 3 SentencePiece
def odd_texts():
    r = random.Random(3)
    parts = ["the", "ing", " ", "   ", "er", "é", "\n", "2024", "!!", "ß", "日", "😀", "\t", "ABC", "http://", "x" * 40]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 50)))) for i in range(200)]
    return rows + [(None, None), (300, ""), (301, " " * 37), (302, "a" + " " * 20 + "b"), (303, "word " * 20000),
                   (304, "ab" * 9000 + "a" * 5001), (305, "-" * 4000 + "=" * 3000), (306, " " * 5000 + "end")]


@pytest.mark.parametrize("hot", [sentencepiece.HOT, 20, 0])
def test_sentencepiece_equals_library(spark, hot):
    import sentencepiece as lib
    sp = lib.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    texts = dict(odd_texts())
    twice = frame(spark, [*texts.items()]).union(frame(spark, [*texts.items()]))
    out = sentencepiece.encode(twice, hot=hot, copies=1 if hot == 20 else sentencepiece.COPIES)
    got = out.select("doc_id", "ids", "n_pieces", "round_trip").collect()
    assert Counter(g.doc_id for g in got) == Counter({d: 2 for d in texts})
    for g in got:
        t = texts[g.doc_id]
        if t is None:
            assert g.ids is None and g.n_pieces is None
        else:
            assert g.ids == sp.encode(t) and g.n_pieces == len(g.ids) and g.round_trip
    if hot == 20:
        back = {x.doc_id: x.text for x in sentencepiece.decode(out.select("doc_id", "ids")).collect()}
        assert back == texts


def test_stable_pairs_equal_merging():
    table = sentencepiece.piece_table()
    pairs = sentencepiece.Pairs(table)
    rank = {p: k for k, (_, p) in enumerate(sorted((-s, p) for _, p, s, b in table if b < 0))}
    text = {i: p for p, i in pairs.id.items()}
    r = random.Random(4)
    short = [i for i, p in text.items() if len(p) <= 3]
    same = [i for i, p in text.items() if len(set(p)) == 1 and len(p) > 1]
    left = r.choices(short, k=8000) + r.choices(list(text), k=4000) + [a for a in same for _ in same]
    right = r.choices(short, k=4000) + r.choices(list(text), k=8000) + [b for _ in same for b in same]
    left, right = left[:30000], right[:30000]
    want = [not any(a < len(text[x]) < e for _, a, _, e in sentencepiece.merges(text[x] + text[y], rank))
            for x, y in zip(left, right)]
    assert pairs(np.array(left), np.array(right)).tolist() == want and 0 < sum(want) < len(want)


def test_sentencepiece_lattice_is_relational(spark):
    seg = spark.createDataFrame([(1, 1, "▁the", 1)], "h1 long, h2 long, segment string, n long")
    plan = sentencepiece.lattice(seg.repartition(2, "h1", "h2", "n"))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    # substrings, equi-join to the pieces, grouping without another exchange, fold
    assert "Generate explode" in physical and "BroadcastHashJoin [piece" in physical
    assert physical.count("Exchange hashpartitioning") == 1 and "aggregate(sequence" in physical


def test_sentencepiece_clashing_names(spark):
    docs = frame(spark, [(1, "the end"), (2, None)]).selectExpr(
        "doc_id", "text", "7 as h1", "8 as row", "9 as rare", "'x' as ids", "1 as t1", "0 as n_pieces", "5 as `a.b`", "6 as `0`")
    out = sentencepiece.encode(docs)
    assert out.columns == ["doc_id", "h1", "row", "rare", "t1", "a.b", "0", "ids", "n_pieces", "round_trip"]
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].h1, got[1].row, got[1].rare, got[1].t1, got[1]["a.b"], got[1]["0"]) == (7, 8, 9, 1, 5, 6)
    assert got[1].round_trip and got[1].n_pieces == len(got[1].ids) and got[2].ids is None
    text = sentencepiece.decode(out)
    assert {r.doc_id: r.text for r in text.collect()} == {1: "the end", 2: None} and "row" in text.columns


# ------------------------------------------------------------------ 5 language
def test_cross_parsing_equals_search():
    training = {"a": "the thing and them an hour", "b": "der die das und ein Haus"}
    m = langid.Model(training)
    for s in ("the thing", "Der und, die!", "", "12 3", "zzz the", "and   them. an x é", " a ", "über"):
        codes = m.codes(s)
        got = m.phrases([codes]).sum(1).tolist() if len(codes) else [0, 0]
        want = []
        for lang in ("a", "b"):
            t, text, i, n = langid.normal(training[lang]), langid.normal(s), 0, 0
            while i < len(text):
                j = i + 1
                while j <= len(text) and text[i:j] in t:
                    j += 1
                n, i = n + 1, max(i + 1, j - 1)
            want.append(n)
        assert got == want


def test_language_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out()).select("text", "lang"))
    extra = spark.createDataFrame([(None, None, None), (7, "", "x"), (8, "12 !", None)], "doc_id long, text string, lang string")
    rows = docs.select("doc_id", "text", "lang").unionByName(extra).withColumn("h", langid.held_out())
    out = langid.identify(rows, model).collect()
    held = [r.lang == r.lang_pred for r in out if r.h and r.lang]
    assert sum(held) / len(held) > 0.97 and all(0 <= r.score <= 1 for r in out)
    assert Counter(r.lang_pred for r in out)["und"] == 3


# --------------------------------------------------------------------- 6 tokens
@pytest.mark.parametrize("block", [64, 1 << 20])
def test_token_counts(spark, block):
    rows = [(d, t) for d, t in corpus() if d is not None] + [(2**62 + 5, "Ā and Ā"), (-9, "z")]
    enc = tokens._encoding(tokens._ranks(tokens.VOCABULARY))
    got = tokens.document_token_counts(frame(spark, rows).repartition(3), block_bytes=block).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((d, len(enc.encode_ordinary(t or ""))) for d, t in rows)


# -------------------------------------------------------------- 7 decontamination
def best_distance(p, t):
    prev = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = [i]
        for j, d in enumerate(t, 1):
            cur.append(min(prev[j - 1] + (c != d), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def test_benchmark_matches(spark):
    r = random.Random(1)
    words = lambda k: " ".join("".join(r.choice("abcde") for _ in range(r.randint(2, 6))) for _ in range(k))
    items = [(i, words(12)) for i in range(6)] + [(None, words(12)), (50, None), (51, "  "), (1, words(10))]
    docs = [(i, words(8)) for i in range(20)]
    for i, (_, t) in enumerate(items):
        if t and t.strip():
            edited = list(t)
            for _ in range(i):
                edited[r.randrange(len(edited))] = "z"
            docs.append((100 + i, words(5) + " " + "".join(edited).upper() + "\n" + words(5)))
    docs += [(None, items[0][1]), (900, None), (901, ""), (100, docs[20][1])]
    got = decontam.benchmark_matches(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_chars=150)
    want = Counter()
    for d, t in docs:
        for i, p in items:
            n, s = decontam.normal(p), decontam.normal(t)
            if n and s and best_distance(n, s) <= decontam.errors(len(n), 0.08, 10):
                want[(d, i, best_distance(n, s))] += 1
    assert Counter((g.doc_id, g.item_id, g.distance) for g in got.collect()) == want and want


# ------------------------------------------------------------------ 8 suffixes
def suffix_brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return by_id(out)


@pytest.mark.parametrize("most", [4096, 2])
def test_suffix_dedup(spark, most):
    rows = corpus(7, 40) + [(2000, "ab" * 300), (2001, "x" * 63)]
    got = suffix_dedup.suffix_dedup(frame(spark, rows), 64, kept_text=False, max_contexts=most)
    assert by_id((r.doc_id, r._n_bytes, r._n_removed, r._n_spans, r._kept) for r in got.collect()) == suffix_brute(rows, 64)


# ------------------------------------------------------------------ 9 licenses
def test_license_scan(spark):
    rows = [(1, "Under the MIT-license, under\nthe mit license"), (2, None), (3, ""), (None, "CC BY NC 4.0"),
            (4, "licensed under the GNU General Public License, version 3"), (5, "SPDX-License-Identifier: LGPL-2.1-only"),
            (6, "mit license der die"), (7, "apache\nlicense (version 2.0)")]
    rows += [(5000 + (d or 0), t) for d, t in corpus(3, 12)]
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    phrases = {p: v for p, v in licenses.BASE_PHRASES.items()}
    want = Counter()
    for d, t in rows:
        w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
        at = [(i, v) for p, v in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        want[(d, len(w), len(at), min((a for a, _ in at), default=None), max((a for a, _ in at), default=None),
              tuple(sorted({v for _, v in at})))] += 1
    assert Counter((g.doc_id, g.n_words, g.n_base, g.first_word, g.last_word, tuple(g.base_labels)) for g in got) == want
    labels = {g.doc_id: g.labels for g in got}
    assert labels[4] == ["gpl-3"] and labels[5] == ["lgpl-2.1"] and "mit" in labels[1] and "cc-by-nc-4" in labels[None]
    assert all(set(g.base_labels) <= set(g.labels) and 0 <= g.score <= 1 for g in got)
    assert len(licenses.signature_rules()) > 300


def test_license_gate_drops_no_match():
    """Gated and ungated scans agree on generated phrasings, and these are found."""
    def scanned(texts, gated):
        raw = [t.encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
        out = licenses.Scanner(gated).scan(np.frombuffer(b"".join(raw), np.uint8), off)
        return [sorted(x) for x in out[5]], out[6].tolist()
    told = ["GPL v2 or any later version", "distributed according to the GPL", "GPLv2", "uses LGPLv2.1 code",
            "the Affero GPLv3 or, at your option, any later version", "\u201cGPL version2\u201d"]
    assert scanned(told, True)[0] == [["gpl-2-or-later"], ["gpl"], ["gpl-2"], ["lgpl-2.1"], ["agpl-3-or-later"], ["gpl-2"]]
    assert scanned(["the EPL match", "the EPL (a license)"], True)[0] == [[], ["epl"]]
    texts = list(told)
    for _, names, versions, _ in licenses.FAMILIES:
        for name, before in itertools.product(names, ("", "released under the terms of the ", "available according to ")):
            texts.append(f"{before}{name} \u2014 see")
            for v, how in itertools.product(versions[-2:], (" {}", " v{}", " version {}", " version{}", "v{}", ", ver {}.0")):
                texts += [f"{before}{name}{how.format(v)}", f"{before}{name}{how.format(v)} or (at your option) any later version"]
    texts += [f"{c}CC-{'-'.join(p)}{v}" for c in ("", "\u00ab") for p in licenses.CC_PARTS for v in ("", " 4.0", "-2.5")]
    texts += [p for _, p, _ in licenses.TEXTS]
    texts = random.Random(2).sample(texts, min(len(texts), 700))
    assert scanned(texts, True) == scanned(texts, False)


# ---------------------------------------------------------------------- 10 urls
def test_url_filter(spark):
    rows = [(1, "http://A.Example.NET/en/x?q"), (2, "https://b.net/z"), (3, "http://net"), (4, None), (5, "no scheme/"),
            (6, "x://example.com/de/1#f"), (7, "http://sub.example.com/de"), (8, "ftp://w.org/fr/"), (9, "http://xnet/"),
            (10, "http://é.org?x/fr/"), (10, "http://é.org?x/fr/"), (None, "http://casino-pills.example.com/"), (11, "a://b://c/d")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit("h")).withColumn("host", F.lit(1))
    got = urls.filter_urls(pages).collect()
    assert len(got) == len(rows)
    for g in got:
        url = next(u for i, u in rows if i == g.page_id)
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path, host = re.match("[^?#]*", rest[len(host):])[0], lower(host)
        fit = [x for x in urls.RULES for h, p in [x.split("/", 1)]
               if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        rule = max(fit, key=len, default=None)
        assert (g.host, g.path, g.rule) == (host, path, rule)
        assert g.verdict == (urls.RULES[rule] if rule else "block" if g.score >= urls.THRESHOLD else "allow")
    assert next(g for g in got if g.page_id is None).verdict == "block"


# ------------------------------------------------------------------ empty tables
def test_empty_tables(spark):
    docs, none = empty(spark), spark.createDataFrame([], "doc_id long, quality int")
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert jaccard.ngram_jaccard_components(docs).count() == 0
    assert quality_bayes.quality_scores(docs, none).count() == 0
    assert sentencepiece.encode(docs).count() == 0
    assert rules.quality_rules(docs, none).count() == 0
    assert langid.identify(docs.select("doc_id", "text"), langid.train(docs.select("text", "lang"))).count() == 0
    assert tokens.document_token_counts(docs).count() == 0
    assert decontam.benchmark_matches(docs, items).count() == 0
    assert suffix_dedup.suffix_dedup(docs).count() == 0
    assert licenses.scan_licenses(docs).count() == 0
    assert urls.filter_urls(pages).count() == 0
    # without labels nothing is learnt: only the base rules reject
    some = frame(spark, [(1, "a " * 60), (2, " ".join(map(str, range(60))))])
    assert {r.doc_id: r.kept for r in rules.quality_rules(some, none).collect()} == {1: False, 2: True}
    assert quality_bayes.quality_scores(some, none).count() == 2
    assert decontam.benchmark_matches(some, items).count() == 0
    assert [r[0] for r in langid.identify(some.select("text"), langid.train(some.select("text", "lang"))).collect()] == ["und"] * 2
