"""Language identification by cross-parsing entropy (operator 5).

For each language a suffix automaton of labelled text recognises exactly the
substrings of that text.  A document is parsed greedily into longest matches
against each automaton (Ziv-Merhav cross parsing); the language that needs
the fewest phrases per character wins.

The training text of a language is a bounded sample: whole documents in the
order of a hash of their content, as long as they fit into ``train_chars``
characters, out of the ``train_docs`` first ones; a language whose documents
are all longer is learned from the beginning of its first one.  Both bounds
are parameters; prediction covers every whole text.

Transitions on the ``DENSE`` most frequent letters are a table, those on
other letters sorted keys that are searched: an automaton of n characters has
fewer than 3 n transitions, so large alphabets cost no more than small ones.

Letters are compared in lower case; everything else, in runs, is one blank.
Texts are parsed in segments of ``SEGMENT`` characters side by side (a
phrase ends where its segment ends, for all languages alike).  A null text,
or one without a letter, is ``und`` with score 0.  Ties go to the first
language in alphabetical order, with score 0.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship

SEGMENT = 1024
LANES = 4096
DENSE = 64


class SuffixAutomaton:
    """States and transitions of the minimal automaton of all substrings."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def add(self, c: str) -> None:
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.link.append(0)
        p = self.last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            if self.length[p] + 1 == self.length[q]:
                self.link[cur] = q
            else:
                copy = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p >= 0 and self.next[p].get(c) == q:
                    self.next[p][c] = copy
                    p = self.link[p]
                self.link[q] = self.link[cur] = copy
        self.last = cur

    def transitions(self, symbols: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(state, symbol, next state) of every transition."""
        n = sum(map(len, self.next))
        out = np.fromiter((x for s, d in enumerate(self.next) for c, to in d.items() for x in (s, symbols[c], to)),
                          dtype=np.int64, count=3 * n).reshape(n, 3)
        return out[:, 0], out[:, 1], out[:, 2]


def normal(text: str) -> str:
    """Lower-case letters, with one blank for each run of anything else."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Model:
    """Automata of several languages, with one symbol table."""

    def __init__(self, training: dict[str, str]):
        self.langs = sorted(training)
        texts = {k: normal(v) for k, v in training.items()}
        seen = Counter("".join(texts.values()))
        letters = sorted(set(seen) - {" "}, key=lambda c: (-seen[c], c))
        # 0: a letter seen in no language, 1: blank, then letters by frequency
        symbols = {" ": 1} | {c: i + 2 for i, c in enumerate(letters)}
        self.n_symbols = np.int64(len(symbols) + 1)
        # symbols from the last column on are rare: that column holds nothing
        self.width = np.int64(min(len(symbols) + 1, DENSE + 2) + 1)
        rare_keys, rare_to, dense, self.root = [], [], [], []
        at = 0
        for k in self.langs:
            a = SuffixAutomaton()
            for c in texts[k]:
                a.add(c)
            state, symbol, to = a.transitions(symbols)
            common = symbol < self.width - 1
            t = np.zeros((len(a.next), self.width), dtype=np.int32)
            t[state[common], symbol[common]] = to[common] + at
            dense.append(t.ravel())
            rare_keys.append((state[~common] + at) * self.n_symbols + symbol[~common])
            rare_to.append(to[~common] + at)
            self.root.append(at)
            at += len(a.next)
        # transitions of all languages together; 0 stands for none, as no
        # transition leads to the first language's root
        self.next = np.concatenate(dense) if dense else np.zeros(0, np.int32)
        keys = np.concatenate(rare_keys) if rare_keys else np.zeros(0, np.int64)
        order = np.argsort(keys)
        # a last key that nothing equals keeps every search inside
        self.rare_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.rare_to = np.append((np.concatenate(rare_to) if rare_to else keys)[order], 0).astype(np.int32)
        self.symbol = np.zeros(0x110000, dtype=np.int32)
        for c, i in symbols.items():
            self.symbol[ord(c)] = i

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """(languages, lanes) states and a symbol per lane -> next states, 0 for none."""
        to = self.next[state * self.width + np.minimum(symbol, self.width - 1)]
        rare = np.flatnonzero(symbol >= self.width - 1)
        if len(rare):
            keys = np.broadcast_to(state, to.shape)[:, rare] * self.n_symbols + symbol[rare]
            at = np.searchsorted(self.rare_keys, keys)
            to[:, rare] = np.where(self.rare_keys[at] == keys, self.rare_to[at], 0)
        return to

    def phrases(self, segments: list[np.ndarray]) -> np.ndarray:
        """(languages, segments): number of phrases of each segment."""
        n = len(segments)
        size = np.array([len(s) for s in segments])
        order = np.argsort(-size, kind="stable")
        longest = int(size.max()) if n else 0
        text = np.zeros((longest, n), dtype=np.int32)
        for lane, i in enumerate(order):
            text[:size[i], lane] = segments[i]
        active = n - np.searchsorted(size[order][::-1], np.arange(longest), "right")
        roots = np.array(self.root, dtype=np.int32)[:, None]
        state = np.repeat(roots, n, 1)
        count = np.zeros((len(self.root), n), dtype=np.int32)
        for t in range(longest):
            m = active[t]
            c = text[t, :m]
            s = state[:, :m]
            to = self.step(s, c)
            stuck = to == 0
            # a match ends before this character, and the next one starts with it
            count[:, :m] += stuck & (s != roots)
            begin = self.step(roots, c)
            to = np.where(stuck, np.where(begin == 0, roots, begin), to)
            # a character unknown to the language is a phrase of its own
            count[:, :m] += stuck & (begin == 0)
            state[:, :m] = to
        count += state != roots
        out = np.zeros_like(count)
        out[:, order] = count
        return out

    def codes(self, text: str) -> np.ndarray:
        """Symbols of a text; empty if it has no letter."""
        cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sym = self.symbol[cp]
        letter = _letters()[cp]
        blank = ~letter
        keep = letter.copy()
        keep[1:] |= blank[1:] & letter[:-1]
        sym = np.where(letter, sym, 1)[keep]
        return sym[:-1] if len(sym) and not letter[keep][-1] else sym

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        total = np.zeros((len(self.langs), n), dtype=np.int64)
        chars = np.zeros(n, dtype=np.int64)
        held, owner = [], []

        def flush():
            if held:
                np.add.at(total.T, np.array(owner), self.phrases(held).T)
                held.clear()
                owner.clear()

        for i, t in enumerate(texts):
            sym = self.codes(t) if t else ()
            chars[i] = len(sym)
            for lo in range(0, len(sym), SEGMENT):
                held.append(sym[lo:lo + SEGMENT])
                owner.append(i)
                if len(held) >= LANES:
                    flush()
        flush()
        if not self.langs:
            return ["und"] * n, np.zeros(n)
        best = total.argmin(0)
        ranked = np.sort(total, axis=0)
        second = ranked[1] if len(self.langs) > 1 else chars
        score = np.where(chars > 0, np.clip((second - ranked[0]) / np.maximum(second, 1), 0.0, 1.0), 0.0)
        return [self.langs[best[i]] if chars[i] else "und" for i in range(n)], score


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def train(rows: DataFrame, train_docs: int = 64, train_chars: int = 24_000) -> Model:
    """rows (text, lang) -> automata; see the module for the sample."""
    known = rows.filter("lang is not null and text is not null").select(
        "lang", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    # long documents come after all others: one that is first is all its language has
    long = F.col("n") > train_chars
    ranked = (known.filter("n > 0").distinct().withColumn("long", long)
              .selectExpr("lang", "h", "long", "row_number() over (partition by lang order by long, h) as r")
              .filter((F.col("r") <= train_docs) & (~F.col("long") | (F.col("r") == 1))))
    # at most train_docs rows per language reach the driver, each of bounded size
    picked = rows.filter("lang is not null and text is not null").withColumn("h", F.xxhash64("text")).join(
        F.broadcast(ranked.select("lang", "h")), ["lang", "h"]).dropDuplicates(["lang", "h"]).withColumn("text", F.substring("text", 1, train_chars))
    texts: dict[str, list[str]] = {}
    for r in sorted(picked.select("lang", "h", "text").collect(), key=lambda r: (r.lang, r.h)):
        have = texts.setdefault(r.lang, [])
        if not have or sum(map(len, have)) + len(r.text) <= train_chars:
            have.append(r.text)
    return Model({k: " ".join(v) for k, v in texts.items()})


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents that are never learnt from (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Replace ``text`` by ``lang_pred`` and ``score``, a row per row."""
    spark = docs.sparkSession
    ship(spark)
    # per language under 2 train_chars states of DENSE + 3 numbers, and the rare transitions
    shared = spark.sparkContext.broadcast(pickle.dumps(model))
    kept = [f for f in docs.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(shared.value)
        for big in batches:
            for lo in range(0, big.num_rows, 1000):
                b = big.slice(lo, 1000)
                lang, score = m.predict(b.column(b.schema.get_field_index("text")).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(f.name) for f in kept] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    [f.name for f in kept] + ["lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double"])
    return docs.mapInArrow(run, schema)
