"""Learned operators against plain Python versions of their formulas."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from marquee.llm import features, langid, quality_bayes, tokens, urls


# -------------------------------------------------------------------- 2 quality
def test_quality_scores_equal_plain_posteriors(spark):
    r = random.Random(5)
    rows = []
    for i in range(300):
        bad = r.random() < 0.3
        words = [r.choice(["good", "plain", "text", "Word", "7", "###" if bad else "and", "a|b"]) for _ in range(r.randint(0, 60))]
        rows.append((i, " ".join(words) if i % 50 else None, r.choice(["h1", "h1", "h2", "h3", None]), r.choice(["p", "q", None]), bad))
    rows += [rows[3], (None, "x y z", "h1", "p", False)]
    docs = spark.createDataFrame([x[:4] for x in rows], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(not b)) for i, _, _, _, b in rows if i is not None and i % 2] + [(1, 0), (None, 1), (4, None)],
                                   "doc_id long, quality int")
    bins = quality_bayes._evidence_bins()
    feats = features.document_counts(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"),
                                                 F.coalesce("lang", F.lit("")).alias("path"), "text"))
    table = feats.select("doc_id", "host", "path", *[v.cast("int").alias(k) for k, v in bins.items()]).collect()
    good = {}
    for x in labels.collect():
        if x.doc_id is not None and x.quality is not None:
            good[x.doc_id] = min(good.get(x.doc_id, 1), x.quality)
    known = [(x, good[x.doc_id]) for x in table if x.doc_id in good]
    n, k = len(known), sum(g for _, g in known)
    p = (k + 1) / (n + 2)
    seen = defaultdict(lambda: [0, 0])
    for x, g in known:
        for f in bins:
            seen[f, x[f]][0] += g
            seen[f, x[f]][1] += 1

    def llr(f, b):
        if (f, b) not in seen:
            return 0.0
        g, m = seen[f, b]
        return math.log((g + 1) / (k + 12)) - math.log((m - g + 1) / (n - k + 12))

    def shrunk(key, parent):
        c = defaultdict(lambda: [0, 0])
        for x, g in known:
            c[key(x)][0] += 1
            c[key(x)][1] += g
        spread = sum(m * (g / m - parent(q)) ** 2 for q, (m, g) in c.items())
        total, squares = sum(m for m, _ in c.values()), sum(m * m for m, _ in c.values())
        within = p * (1 - p)
        between = (spread - (len(c) - 1) * within) / (total - squares / total)
        s = min(1e6, max(1.0, within / between - 1)) if between > 0 else 1e6
        return {q: (g + s * parent(q)) / (m + s) for q, (m, g) in c.items()}

    hosts = shrunk(lambda x: x.host, lambda q: p)
    paths = shrunk(lambda x: (x.host, x.path), lambda q: hosts[q[0]])
    want = Counter()
    for x in table:
        e = 0.5 * sum(llr(f, x[f]) for f in bins)
        share = paths.get((x.host, x.path), hosts.get(x.host, p))
        want[x.doc_id, round(1 / (1 + math.exp(-(math.log(share / (1 - share)) + e))), 9)] += 1
    got = quality_bayes.quality_scores(docs, labels).collect()
    assert Counter((x.doc_id, round(x.score, 9)) for x in got) == want
    assert all(x.kept == (x.score >= 0.5) for x in got)


# ------------------------------------------------------------------- 5 language
@pytest.mark.parametrize("letters", [5, 400])
def test_language_equals_plain_parse(letters):
    r = random.Random(letters)
    abc = [chr(0x4E00 + i) for i in range(letters)] + [" "] * (letters // 4 + 1)
    training = {k: "".join(r.choice(abc) for _ in range(900)) for k in ("a", "b", "c")}
    m = langid.Model(training)
    texts = []
    for i in range(60):
        base = langid.normal(training["abc"[i % 3]])
        at = r.randrange(len(base) - 60)
        s = list(base[at:at + 60])
        for _ in range(r.randrange(12)):
            s[r.randrange(len(s))] = r.choice([*abc, "x"])
        texts.append("".join(s))
    lang, score = m.predict(texts)
    for s, pred, sc in zip(texts, lang, score):
        text, counts = langid.normal(s), []
        for k in m.langs:
            t, i, n = langid.normal(training[k]), 0, 0
            while i < len(text):
                j = i + 1
                while j <= len(text) and text[i:j] in t:
                    j += 1
                n, i = n + 1, max(i + 1, j - 1)
            counts.append(n)
        first, second = sorted(counts)[:2]
        assert pred == m.langs[counts.index(first)] and abs(sc - (second - first) / max(second, 1)) < 1e-12


def test_large_alphabets_take_little_memory():
    r = random.Random(1)
    training = {k: "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(24_000)) for k in "abcd"}
    m = langid.Model(training)
    assert m.next.nbytes + m.rare_keys.nbytes + m.rare_to.nbytes + m.symbol.nbytes < 100_000_000
    assert m.predict([training["c"][500:700]])[0] == ["c"]


def test_language_of_long_documents_only(spark):
    rows = [("en", "the cat sat on the mat and then it ran")] + [("fr", "le chat est sur la table " * 40)] * 2 + [("fr", None), (None, "x")]
    m = langid.train(spark.createDataFrame(rows, "lang string, text string"), train_chars=100)
    assert m.langs == ["en", "fr"]
    assert m.predict(["le chat sur la table", "the cat ran"])[0] == ["fr", "en"]


# --------------------------------------------------------------------- 6 tokens
@pytest.mark.parametrize("block", [64, 1 << 20])
def test_token_counts_of_null_ids(spark, block):
    rows = [(None, "a b c"), (None, "a b c"), (None, None), (0, ""), (-1, "x " * 100), (-(2**63), "y"), (2**63 - 1, "z")]
    enc = tokens._encoding(tokens._ranks(tokens.VOCABULARY))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = tokens.document_token_counts(docs, block_bytes=block).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((d, len(enc.encode_ordinary(t or ""))) for d, t in rows)


# ----------------------------------------------------------------------- 10 urls
def _plain_features(url, sizes, dims):
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0].lower()
    path = re.match("[^?#]*", rest[len(host):])[0]
    out = set()
    for mark, s in (("^", host), ("~", path)):
        t = mark + s + "$"
        for n in sizes:
            for i in range(len(t) - n + 1):
                h = xxhash.xxh64_intdigest(t[i:i + n].encode(), seed=42)
                out.add((h - (1 << 64) if h >> 63 else h) % dims)
    return sorted(out)


def test_url_score_equals_plain_regression(spark):
    sizes, dims = (3, 4), 1 << 12
    rows = urls.LABELLED_URLS[::9]
    w, bias = urls.train(spark.createDataFrame(rows, "url string, blocked int"), sizes, dims, steps=80)
    x = np.zeros((len(rows), dims + 1))
    for i, (u, _) in enumerate(rows):
        idx = _plain_features(u, sizes, dims)
        x[i, idx] = 1 / math.sqrt(len(idx))
    x[:, dims] = 1.0
    y, v = np.array([b for _, b in rows], dtype=float), np.zeros(dims + 1)
    for _ in range(80):
        p = 1 / (1 + np.exp(-(x @ v)))
        v -= 6.0 * (x.T @ (p - y) / len(y) + 0.0001 * v)
    assert np.allclose(np.append(w, bias), v, atol=1e-8)
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    out = urls.filter_urls(pages, spark.createDataFrame(rows, "url string, blocked int"), {}, sizes, dims)
    assert out.count() == len(rows) and {r.verdict for r in out.collect()} == {"allow", "block"}


def test_url_model_on_held_out_hosts(spark):
    labelled, held = ({u.split("/")[2] for u, _ in t} for t in (urls.LABELLED_URLS, urls.HELD_OUT_URLS))
    rows = [x for x in urls.HELD_OUT_URLS if x[0].split("/")[2] not in labelled]
    assert len(rows) > 300
    pages = spark.createDataFrame([(u, b) for u, b in rows], "url string, truth int")
    out = urls.filter_urls(pages, rules={}).collect()
    hit = [r.verdict == "block" for r in out if r.truth]
    wrong = [r.verdict == "block" for r in out if not r.truth]
    assert sum(hit) / len(hit) >= 0.9 and sum(wrong) / len(wrong) <= 0.05
