r"""License scan by ordered signature rules (operator 9).

Text is read as words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in lower case (A-Z).
Two kinds of rules find license statements:

* base phrases: places where the words of a phrase stand consecutively;
* signature rules: regular expressions over the words joined by one blank.
  A rule runs only on documents that hold all of its keywords (prefilter):
  words that stand in every match of its pattern, read as runs of ASCII
  letters and digits.  The bare names in ``AMBIGUOUS`` also mean other things
  and count only where the text has a word of ``CONTEXT`` somewhere.

Detections overlap ("gpl" inside "gnu lesser gpl version 2.1"), so they are
resolved in order of priority: a detection that lies inside one kept before
is dropped.  Base detections have the highest priority and are always kept.
``score`` is the largest weight of a kept detection, 0 without one.

The rules are generated from a table of license families, their names and
versions, and a list of phrasings (:func:`signature_rules`).  Null and empty
texts have no words and no labels.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm import scan
from marquee.llm.common import ship

#: phrase -> label
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# family: label stem, names as they are written, versions, keywords of the names
FAMILIES = (
    ("gpl", ("gnu general public license", "gnu gpl", "gpl"), ("1", "2", "3"), 3),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("2", "2.1", "3"), 4),
    ("agpl", ("gnu affero general public license", "affero gpl", "agpl"), ("1", "3"), 4),
    ("gfdl", ("gnu free documentation license", "gfdl"), ("1.1", "1.2", "1.3"), 2),
    ("apache", ("apache software license", "apache license", "asl"), ("1", "1.1", "2"), 3),
    ("mpl", ("mozilla public license", "mpl"), ("1", "1.1", "2"), 3),
    ("epl", ("eclipse public license", "epl"), ("1", "2"), 3),
    ("cddl", ("common development and distribution license", "cddl"), ("1", "1.1"), 3),
    ("eupl", ("european union public licence", "eupl"), ("1", "1.1", "1.2"), 3),
    ("afl", ("academic free license", "afl"), ("1.1", "2", "2.1", "3"), 2),
    ("osl", ("open software license", "osl"), ("1", "2", "2.1", "3"), 2),
    ("artistic", ("artistic license",), ("1", "2"), 2),
    ("cecill", ("cecill",), ("1", "2", "2.1"), 2),
    ("lppl", ("latex project public license", "lppl"), ("1", "1.2", "1.3"), 2),
    ("ms-pl", ("microsoft public license",), (), 2),
    ("ms-rl", ("microsoft reciprocal license",), (), 2),
    ("bsl", ("boost software license",), ("1",), 2),
    ("mit", ("mit license", "mit x11 license", "expat license"), (), 2),
    ("isc", ("isc license",), (), 2),
    ("zlib", ("zlib license", "zlib libpng license"), (), 2),
    ("bsd-2-clause", ("simplified bsd license", "freebsd license", "2 clause bsd license", "bsd 2 clause"), (), 3),
    ("bsd-3-clause", ("revised bsd license", "modified bsd license", "new bsd license", "3 clause bsd license", "bsd 3 clause"), (), 3),
    ("bsd-4-clause", ("original bsd license", "4 clause bsd license", "bsd 4 clause"), (), 3),
    ("bsd", ("bsd license", "bsd style license"), (), 1),
    ("unlicense", ("the unlicense",), (), 2),
    ("wtfpl", ("wtfpl",), ("2",), 2),
    ("python", ("python software foundation license", "psf license"), ("2",), 2),
    ("ofl", ("sil open font license", "ofl"), ("1", "1.1"), 2),
    ("cc0", ("cc0", "creative commons zero"), ("1",), 3),
    ("odbl", ("open database license", "odbl"), ("1",), 2),
    ("proprietary", ("proprietary license", "commercial license"), (), 1),
)
SHORT_NAMES = frozenset(n for _, names, _, _ in FAMILIES for n in names if " " not in n)
#: parts of a Creative Commons name: code words and spelled out
CC_PARTS = (("by",), ("by", "sa"), ("by", "nd"), ("by", "nc"), ("by", "nc", "sa"), ("by", "nc", "nd"))
CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?", "nc": "non ?commercial"}
CC_VERSIONS = ("1", "2", "2.5", "3", "4")
#: short names that mean a license only in texts that speak of one
AMBIGUOUS = ("asl", "mpl", "epl", "afl", "osl", "ofl")
CONTEXT = ("license", "licenses", "licensed", "licence", "licences", "licenced", "licensing")
#: texts that are characteristic of a license without naming it
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ("hereby", "granted", "charge")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", ("permission", "distribute", "purpose")),
    ("bsd", "redistributions of source code must retain the above copyright notice", ("redistributions", "retain")),
    ("bsd-3-clause", "neither the names? of .{0,60}? may be used to endorse or promote products", ("neither", "endorse")),
    ("zlib", "altered source versions must be plainly marked", ("altered", "plainly")),
    ("unlicense", "free and unencumbered software released into the public domain", ("unencumbered",)),
    ("public-domain", "(?:released|placed|dedicated) (?:in ?to|to|in) the public domain", ("public", "domain")),
    ("all-rights-reserved", "all rights reserved", ("rights", "reserved")),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: tuple[str, ...]
    priority: int
    weight: float
    context: bool = False


def _version(v: str) -> str:
    """A version as words: 2.1 is `2 1`; a whole number may end in `0`."""
    return v.replace(".", " ") if "." in v else f"{v}(?: 0)?"


@cache
def signature_rules() -> tuple[Rule, ...]:
    """All rules, highest priority first."""
    rules = []
    for stem, names, versions, rank in FAMILIES:
        forms = {f: rf"(?:licensed|released|distributed|available|published) {f} (?:the terms of )?"
                 for f in ("under", "according to")}
        said = "(?:" + "|".join(forms.values()) + ")"
        for name in names:
            words = tuple(w for w in name.split() if w not in ("the", "and"))
            n = f"(?:the )?{name}"
            # the longer match takes in what the plain rules below would find inside it
            long = f"(?:{said})?{n}"
            fsf = "(?:as published by the free software foundation )?(?:either )?"
            later = "(?:of the license )?or (?:at your option )?any later"
            short = words[-1] in SHORT_NAMES
            for v in versions:
                label, ver = f"{stem}-{v}", _version(v)
                num = tuple(v.split("."))
                # the number as a word of its own, after "v", and after the name ("gplv2")
                rules += [
                    Rule(label, rf"\b{long} (?:(?:version|ver|v) )?{ver}\b", words + num, 60 + 5 * rank, 0.9),
                    Rule(label, rf"\b{long} (?:version|ver|v){ver}\b", words, 60 + 5 * rank, 0.9),
                    Rule(f"{label}-or-later", rf"\b{long} {fsf}(?:(?:version|v) )?{ver} {later}\b",
                         words + num + ("later",), 70 + 5 * rank, 0.95),
                    Rule(f"{label}-or-later", rf"\b{long} {fsf}(?:version|v){ver} {later}\b",
                         words + ("later",), 70 + 5 * rank, 0.95),
                ]
                if short:
                    joined = (*words[:-1], f"{words[-1]}v{num[0]}", *num[1:])
                    rules += [
                        Rule(label, rf"\b{long}v{ver}\b", joined, 60 + 5 * rank, 0.9),
                        Rule(f"{label}-or-later", rf"\b{long}v{ver} {later}\b", joined + ("later",), 70 + 5 * rank, 0.95),
                    ]
            rules += [Rule(stem, rf"\b{pattern}{n}\b", words + (f.split()[0],), 40 + 5 * rank, 0.85)
                      for f, pattern in forms.items()]
            rules.append(Rule(stem, rf"\b{n}\b", words, 20 + 5 * rank, 0.6, name in AMBIGUOUS))
    for parts in CC_PARTS:
        code, spelled = " ".join(parts), " ".join(CC_WORDS[p] for p in parts)
        stem, rank = "cc-" + "-".join(parts), 2 * len(parts)
        for v in CC_VERSIONS:
            rules += [
                Rule(f"{stem}-{v}", rf"\bcc {code} {_version(v)}\b", ("cc", *parts, v.split(".")[0]), 80 + rank, 0.95),
                Rule(f"{stem}-{v}", rf"\bcreative commons {spelled} {_version(v)}\b", ("creative", "commons"), 80 + rank, 0.95),
            ]
        rules += [
            Rule(stem, rf"\bcc {code}\b", ("cc", *parts), 50 + rank, 0.8),
            Rule(stem, rf"\bcreative commons {spelled}(?: \d \d)?(?: international| unported| generic)?(?: public)? licen[cs]e\b",
                 ("creative", "commons"), 55 + rank, 0.9),
        ]
    rules += [Rule(label, rf"\b{p}\b", kw, 90, 0.95 if label != "all-rights-reserved" else 0.5) for label, p, kw in TEXTS]
    # SPDX tags: the identifier's words follow the tag
    for stem, _, versions, _ in FAMILIES:
        for v in versions or ("",):
            ident = (stem + (f"-{v}" if v else "")).replace("-", " ")
            rules.append(Rule(stem + (f"-{v}" if v else ""),
                              rf"\bspdx license identifier {ident.replace('.', ' ')}(?: 0)?(?: only| or later)?\b",
                              ("spdx", "identifier"), 95, 1.0))
    return tuple(sorted(rules, key=lambda r: (-r.priority, r.label, r.pattern)))


def resolve(found: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Keep detections (priority, start, end, label, weight) not inside a kept one of another label."""
    kept: list[tuple[int, int, int, str, float]] = []
    for d in sorted(found, key=lambda x: (-x[0], -(x[2] - x[1]), x[1], x[3])):
        if not any(k[1] <= d[1] and d[2] <= k[2] for k in kept):
            kept.append(d)
    return kept


NOT_ASCII_ALNUM = scan.NOT_ALNUM.copy()
NOT_ASCII_ALNUM[0x80:] = True


def _hash(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(scan.range_hash(b, np.array([0]), np.array([len(b)]))[0])


class Scanner:
    """Compiled rules; made once per task.  ``gated`` is off only in tests."""

    def __init__(self, gated: bool = True):
        self.gated = gated
        self.phrases = [(np.array([_hash(x) for x in p.split()], dtype=np.uint64), label)
                        for p, label in BASE_PHRASES.items()]
        self.rules = [(r, re.compile(r.pattern), frozenset(_hash(k) for k in r.keywords)) for r in signature_rules()]
        self.context = frozenset(_hash(k) for k in CONTEXT)
        self.keys = np.array(sorted(self.context.union(*(kw for _, _, kw in self.rules))), dtype=np.uint64)

    def base(self, w: scan.Words, phrase: np.ndarray) -> np.ndarray:
        n = len(w.hash) - len(phrase) + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(w.hash[:n] == phrase[0])
        for j in range(1, len(phrase)):
            at = at[w.hash[at + j] == phrase[j]]
        return at[w.doc[at] == w.doc[at + len(phrase) - 1]]

    def scan(self, data: np.ndarray, off: np.ndarray):
        """Per document: words, base places, first and last, labels, score."""
        data = scan.LOWER[data]
        w = scan.words(data, off, scan.NOT_ALNUM)
        m = len(off) - 1
        n_base = np.zeros(m, np.int64)
        first, last = np.full(m, np.iinfo(np.int64).max), np.full(m, -1)
        base: dict[int, list] = defaultdict(list)
        for phrase, label in self.phrases:
            at = self.base(w, phrase)
            doc = w.doc[at]
            np.add.at(n_base, doc, 1)
            np.minimum.at(first, doc, at - w.first[doc])
            np.maximum.at(last, doc, at - w.first[doc])
            for d, a in zip(doc.tolist(), (at - w.first[doc]).tolist()):
                base[d].append((1000, a, a + len(phrase), label, 0.9))
        # prefilter: which rule keywords each document holds; a pattern's \b also
        # stands beside quotes and dashes beyond ASCII, which are part of a word
        g = scan.words(data, off, NOT_ASCII_ALNUM) if len(data) and data.max() > 127 else w
        have: dict[int, set] = defaultdict(set)
        pos = np.searchsorted(self.keys, g.hash)
        pos[pos == len(self.keys)] = 0
        hit = np.flatnonzero(self.keys[pos] == g.hash) if len(g.hash) else np.zeros(0, np.int64)
        for d, h in zip(g.doc[hit].tolist(), g.hash[hit].tolist()):
            have[d].add(h)
        labels, score = [[] for _ in range(m)], np.zeros(m)
        for d in sorted(base.keys() | have.keys()) if self.gated else range(m):
            found = list(base[d])
            told = not self.context.isdisjoint(have[d])
            todo = [(r, rx) for r, rx, kw in self.rules if (kw <= have[d] or not self.gated) and (told or not r.context)]
            if todo:
                lo, hi = w.first[d], w.first[d + 1]
                text = b" ".join(data[a:b].tobytes() for a, b in zip(w.start[lo:hi], w.end[lo:hi])).decode("utf-8", "replace")
                blanks = np.array([i for i, c in enumerate(text) if c == " "])
                for r, rx in todo:
                    for x in rx.finditer(text):
                        a, b = np.searchsorted(blanks, (x.start(), x.end()))
                        found.append((r.priority, int(a), int(b) + 1, r.label, r.weight))
            kept = resolve(found)
            labels[d] = sorted({k[3] for k in kept} | {b[3] for b in base[d]})
            score[d] = max((k[4] for k in kept), default=0.0)
        base_labels = [sorted({x[3] for x in base[d]}) if d in base else [] for d in range(m)]
        return np.diff(w.first), n_base, first, last, base_labels, labels, score


def _batches(batches) -> Iterator[pa.RecordBatch]:
    s = Scanner()
    for b in batches:
        ids = b.column(b.schema.get_field_index("doc_id"))
        for lo, hi, data, off in scan.slices(b.column(b.schema.get_field_index("text"))):
            n, n_base, first, last, base, labels, score = s.scan(data, off)
            none = n_base == 0
            yield pa.RecordBatch.from_arrays([
                ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(n_base, pa.int64()),
                pa.array(first, pa.int64(), mask=none), pa.array(last, pa.int64(), mask=none),
                pa.array(base, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string())),
                pa.array(score, pa.float64())],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> a row per document, with arrays of labels."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _batches, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels array<string>, labels array<string>, score double")
