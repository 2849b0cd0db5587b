"""Operator 13: spelling variants by dynamic programming over sorted word lists.

Two words are near if one edit (a code point inserted, deleted or replaced)
turns one into the other.  With m = half the shorter length, near words share
their first m code points, or, read backwards, their last m.  Words are dealt
to units by such a prefix, forwards and backwards; a unit is a sorted list.
Inside it the edit matrix of every query against the list is computed row by
row in a band of three cells: list words with a common prefix (by the LCPs of
neighbours) share its rows, and a range whose prefix is already more than one
edit away is skipped.

A unit of more than ``CROWD`` words is split without loss: words that also
agree in the next code point meet in the unit of the longer prefix, the
others must differ exactly there and meet in the unit of the string that is
left without it, which an alphabet bounds.  Every pair is kept in one unit.

Defined results: a null text has no words; a null doc_id is written as an
empty text in the hash; repeated rows count as often as they occur; ties go
to the smallest word in code-point order; an empty table gives an empty
result.  Only ``doc_id`` and ``text`` are read, so further columns cannot
clash.  Very long texts are taken whole, one at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise, ship

#: words of a unit, and about that of a batch of units
CROWD = 1 << 14
#: distinct words that a task holds before it passes their counts on
HELD_WORDS = 1 << 19
FAR = np.int8(2)
UNIT = ("backward", "half", "prefix", "exact", "key")
UNIT_SCHEMA = "backward boolean, half int, prefix int, exact boolean, key string, word string, n long"


# ------------------------------------------------------------------- words
def _text_words(batches: Iterator[pa.RecordBatch], min_length: int, typo_every: int) -> Iterator[pa.RecordBatch]:
    """Partial (word, n) rows; in Latin-1 a code point up to U+00FF is one byte, all others become '?'."""
    run = re.compile(rb"[a-z\xc0-\xff]{%d,}" % min_length)
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for b in batches:
        for doc_id, text in zip(b.column(0), b.column(1)):
            if (text := text.as_py()) is None:
                continue
            own = crc32(f"{'' if (i := doc_id.as_py()) is None else i}:".encode())
            # bytes.lower() changes A to Z only
            for word, n in Counter(run.findall(text.encode("latin-1", "replace").lower())).items():
                h = crc32(word if word.isascii() else word.decode("latin-1").encode(), own)
                if h % typo_every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                    if len(word) < min_length:
                        continue
                held[word] += n
            if len(held) >= HELD_WORDS:
                yield rows()
                held.clear()
    if held:
        yield rows()


def word_counts(docs: DataFrame, min_length: int = 7, min_count: int = 2, typo_every: int = 31) -> DataFrame:
    """(word, n): lower-cased letter runs with their occurrences.

    A run whose ``crc32("<doc_id>:<run>")`` is divisible by ``typo_every`` loses
    the code point at that hash modulo its length; words of ``min_length`` code
    points and ``min_count`` occurrences or more stay.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text").mapInArrow(
        lambda it: _text_words(it, min_length, typo_every), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ------------------------------------------------------------- sorted lists
def _near(code: np.ndarray, off: np.ndarray, ln: np.ndarray, new_unit: np.ndarray) -> Iterator[tuple]:
    """(query, list entry) pairs one edit apart among the sorted words of each unit.

    A state is a query with a range of the list whose words share their first
    ``d`` code points, and row ``d`` of their edit matrix, cells d-1 to d+1.
    """
    n = len(ln)
    unit = np.flatnonzero(new_unit)
    of = np.cumsum(new_unit) - 1
    q = np.arange(n)
    lo, hi = unit[of], np.append(unit[1:], n)[of]
    r0, r1, r2 = np.full(n, FAR), np.zeros(n, np.int8), np.ones(n, np.int8)
    same = ~new_unit  # shares its first d code points with the entry above
    d = 0
    while len(q):
        ended = np.flatnonzero(ln[lo] == d)
        if len(ended):
            k = ln[q[ended]] - d
            dist = np.select([k == -1, k == 0, k == 1], [r0[ended], r1[ended], r2[ended]], FAR)
            hit = ended[dist == 1]
            yield q[hit], lo[hit]
            lo = lo.copy()
            lo[ended] += 1
        keep = (lo < hi) & ~((hi - lo == 1) & (lo == q))
        q, lo, hi, r0, r1, r2 = (x[keep] for x in (q, lo, hi, r0, r1, r2))
        if not len(q):
            return
        # ranges of the next code point, from the LCPs of neighbours
        more = ln > d
        ch = np.zeros(n, np.uint32)
        ch[more] = code[off[more] + d]
        same[1:] &= more[1:] & more[:-1] & (ch[1:] == ch[:-1])
        breaks = np.flatnonzero(~same)
        start = breaks[more[breaks]]
        end = np.append(breaks, n)[np.searchsorted(breaks, start) + 1]
        a, b = np.searchsorted(start, lo), np.searchsorted(start, hi)
        count = b - a
        from_ = np.repeat(np.arange(len(q)), count)
        child = np.arange(len(from_)) - np.repeat(np.cumsum(count) - count, count) + a[from_]
        q = q[from_]
        lo, hi = start[child], end[child]
        c = ch[lo]

        def differs(j: int) -> np.ndarray:
            """Whether code point j of the query is not c (or not there)."""
            there = (ln[q] > j) & (j >= 0)
            out = np.ones(len(q), np.int8)
            out[there] = code[off[q[there]] + j] != c[there]
            return out

        p0, p1, p2 = r0[from_], r1[from_], r2[from_]
        size = ln[q]
        r0 = np.minimum(p1 + 1, p0 + differs(d - 1))
        r0[size < d] = FAR
        r1 = np.minimum(np.minimum(p2 + 1, r0 + 1), p1 + differs(d))
        r1[size < d + 1] = FAR
        r2 = np.minimum(r1 + 1, p2 + differs(d + 1))
        r2[size < d + 2] = FAR
        r0, r1, r2 = (np.minimum(x, FAR).astype(np.int8) for x in (r0, r1, r2))
        keep = np.minimum(np.minimum(r0, r1), r2) <= 1
        q, lo, hi, r0, r1, r2 = (x[keep] for x in (q, lo, hi, r0, r1, r2))
        d += 1


def _unit_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) rows, both ways, of whole units sorted by unit and word."""

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        col = {c: t.column(c).combine_chunks() for c in t.column_names}
        words = col["word"].to_pylist()
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ln = pc.utf8_length(col["word"]).to_numpy().astype(np.int64)
        off = np.cumsum(ln) - ln
        new = _changes(t)
        half, prefix = (col[c].to_numpy().astype(np.int64) for c in ("half", "prefix"))
        exact, backward = (col[c].to_numpy(zero_copy_only=False) for c in ("exact", "backward"))
        there = ln > prefix
        at = np.zeros(len(ln), np.uint32)
        at[there] = code[(off + prefix)[there]]
        ids: dict[str, int] = {}
        tail = np.array([ids.setdefault(w[len(w) - h:], len(ids)) if r else -1
                         for w, h, r in zip(words, half, backward)], np.int64)
        reverse = pc.utf8_reverse(col["word"])
        shown = pc.if_else(col["backward"], reverse, col["word"])
        for q, e in _near(code, off, ln, new):
            # the one unit that keeps the pair
            keep = np.minimum(ln[q], ln[e]) // 2 == half[q]
            keep &= ~backward[q] | (tail[q] != tail[e])
            keep &= ~exact[q] | (at[q] != at[e])
            q, e = q[keep], e[keep]
            if len(q):
                yield pa.RecordBatch.from_arrays([shown.take(pa.array(q)), shown.take(pa.array(e)),
                                                  col["n"].take(pa.array(e))], ["word", "near", "near_n"])

    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= 2 * CROWD:
            t = pa.Table.from_batches(held)
            last = int(np.flatnonzero(_changes(t))[-1])  # the last unit may go on
            if last:
                yield from solve(t.slice(0, last))
            held = t.slice(last).to_batches()
            n -= last
    if n:
        yield from solve(pa.Table.from_batches(held))


def _changes(t: pa.Table) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in UNIT:
        col = t.column(c).combine_chunks()
        new[1:] |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
    return new


# -------------------------------------------------------------------- units
def _units(words: DataFrame) -> DataFrame:
    """Units by the shared half: a word meets words of its length and up, and of one less."""
    ways = words.selectExpr("n", "explode(array(struct(false as backward, word as word), "
                            "struct(true as backward, reverse(word) as word))) as w").selectExpr("n", "w.backward", "w.word")
    halves = ways.selectExpr("*", "explode(array_distinct(array(length(word) div 2, (length(word) - 1) div 2))) as h")
    return halves.selectExpr("backward", "cast(h as int) as half", "cast(h as int) as prefix", "false as exact",
                             "substring(word, 1, cast(h as int)) as key", "word", "n")


def _split(crowded: DataFrame) -> DataFrame:
    """Units of crowded ones: the next longer prefix, and the strings left without the next code point."""
    longer = crowded.filter("length(word) > prefix").selectExpr(
        "backward", "half", "prefix + 1 as prefix", "false as exact", "substring(word, 1, prefix + 1) as key", "word", "n")
    left = "concat(substring(word, 1, prefix), substring(word, prefix + 2))"
    exact = crowded.selectExpr("backward", "half", "prefix", "true as exact",
                               f"explode(array_distinct(array(word, {left}))) as key", "word", "n")
    return longer.unionByName(exact)


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, near, near_n) for all ordered pairs of ``words`` (word, n) one edit apart."""
    spark = words.sparkSession
    ship(spark)
    todo = _units(words.filter("word <> ''"))
    done = []
    while True:
        todo = materialise(todo, "spelling-units")
        big = materialise(todo.filter("not exact").groupBy(*UNIT).count().filter(F.col("count") > crowd)
                          .select(*UNIT), "spelling-crowded")
        if big.isEmpty():
            done.append(todo)
            break
        done.append(todo.join(big, list(UNIT), "left_anti").select(*todo.columns))
        todo = _split(todo.join(big, list(UNIT), "left_semi").select(*todo.columns))
    units = done[0]
    for u in done[1:]:
        units = units.unionByName(u)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(parts, *UNIT).sortWithinPartitions(*UNIT, "word").mapInArrow(
        _unit_pairs, "word string, near string, near_n long")


def spelling_variants(words: DataFrame, ratio: int = 10, crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words`` (word, n; words are distinct).

    The form is the near word of largest n, if that is at least ``ratio`` times
    the word's; the root is where following forms ends.
    """
    words = materialise(words.select("word", "n"), "spelling-words")
    near = near_pairs(words, crowd).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near")).alias("best"))
    rows = materialise(words.join(near, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) as n_near", f"if(best.near_n >= {ratio} * n, best.near, null) as form",
        f"if(best.near_n >= {ratio} * n, best.near_n, null) as form_n"), "spelling-forms")
    # n grows along a chain, so it ends; each round doubles the steps taken
    at = rows.filter("form is not null").selectExpr("word", "form as root")
    while True:
        ahead = at.selectExpr("word as root", "root as next")
        at = materialise(at.join(ahead, "root", "left").selectExpr("word", "coalesce(next, root) as root",
                                                                   "next is not null as moved"), "spelling-roots")
        if at.filter("moved").isEmpty():
            break
        at = at.drop("moved")
    return rows.join(at.select("word", "root"), "word", "left").selectExpr(
        "word", "form", "coalesce(root, word) as root", "n", "n_near", "form_n")
