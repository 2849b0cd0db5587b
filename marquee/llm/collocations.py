"""Operator 11: phrase collocations by mergeable Misra-Gries summaries.

Pass 1 cuts every text into blocks of words and counts a block's phrases of
one to three words exactly.  The phrases are dealt by hash to ``buckets``; a
block sends one packed row to each bucket.  A phrase that reaches the
threshold inside a block is certain; all others go into the bucket's
Misra-Gries summary, whose capacity exceeds the bucket's mass divided by the
threshold, so that what its decrements take from any counter stays below the
threshold and no frequent phrase can be lost.  The summaries' survivors are
kept in a bitmap of fixed size (one segment a bucket).

Pass 2 reads the texts again and counts exactly every phrase that the bitmap
lets through.  The bitmap only spares work: a phrase let through by chance is
counted like the others and falls below the threshold.

Defined results: a null text is empty; a null lang is ``und``; texts without
words add nothing; repeated rows count as often as they occur; ties are
broken by phrase in UTF-8 byte order; an empty table gives an empty result.
Only ``lang`` and ``text`` are read, so further columns cannot clash.  A text
of any length is cut into blocks at word boundaries without losing the
phrases across a cut; a worker holds some 50 bytes for each byte of the
longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import scan
from marquee.llm.common import materialise, ship

U64 = np.uint64
#: words of a block; three word codes fit into 63 bits
BLOCK_WORDS = 1 << 19
CODE_BITS = 21
#: phrases of a block that are handled at a time
PART = 1 << 18
CODE = U64((1 << CODE_BITS) - 1)

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09]] = True
DELIMITER = np.zeros(256, dtype=bool)
DELIMITER[[*b".,;:!?", *range(0x0A, 0x0E)]] = True


# ------------------------------------------------------------------- blocks
def _words(data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of one slice and the number of the piece each stands in."""
    delimiter = DELIMITER[data]
    inside = ~(delimiter | BLANK[data])
    start, end = scan.runs(inside, off)
    piece = np.cumsum(delimiter)[start] if len(start) else np.zeros(0, np.int64)
    piece = piece + np.searchsorted(off, start, "right")
    ends = np.zeros(len(start) + 1, dtype=np.int32)
    np.cumsum(end - start, out=ends[1:])
    text = scan.LOWER[data[inside]]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(text)]), piece


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """(lang, distinct words, unique phrase keys, counts) of blocks of words.

    A key holds up to three word codes (from 1), the last word lowest.
    """
    held: dict[str, list] = {}
    n_held = 0

    def close(lang: str, parts: list) -> Iterator[tuple]:
        words = pa.concat_arrays([w for w, _ in parts])
        step, pieces = 0, []
        for _, p in parts:
            pieces.append(p + step)
            step += int(p[-1]) + 1 if len(p) else 0
        piece = np.concatenate(pieces)
        n = len(words)
        for lo in range(0, n, BLOCK_WORDS):
            # two more words finish the phrases that start in the block
            m = min(BLOCK_WORDS, n - lo)
            enc = words.slice(lo, m + 2).dictionary_encode()
            c = enc.indices.to_numpy().astype(np.uint64) + U64(1)
            p = piece[lo:lo + m + 2]
            keys = [c[:m]]
            two = np.flatnonzero(p[:-1] == p[1:])
            two = two[two < m]
            keys.append((c[two] << U64(CODE_BITS)) | c[two + 1])
            three = np.flatnonzero(p[:-2] == p[2:])
            three = three[three < m]
            keys.append((c[three] << U64(2 * CODE_BITS)) | (c[three + 1] << U64(CODE_BITS)) | c[three + 2])
            yield (lang, enc.dictionary, *_distinct(np.concatenate(keys)))

    for b in batches:
        lang = b.column(b.schema.get_field_index("lang"))
        text = b.column(b.schema.get_field_index("text"))
        for value in lang.unique().to_pylist():
            for _, _, data, off in scan.slices(text.filter(pc.equal(lang, value))):
                w, piece = _words(data, off)
                if len(w):
                    held.setdefault(value, []).append((w, piece))
                    n_held += len(w)
                if n_held >= BLOCK_WORDS - (1 << 17):
                    for k, parts in held.items():
                        yield from close(k, parts)
                    held, n_held = {}, 0
                    pa.default_memory_pool().release_unused()
    for k, parts in held.items():
        yield from close(k, parts)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their counts; sorts ``keys`` in place."""
    keys.sort()
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.diff(np.append(at, len(keys)))


def _codes(keys: np.ndarray) -> list[np.ndarray]:
    """Word numbers of the keys, first word first; -1 where a key has fewer words."""
    c = [((keys >> U64(s)) & CODE).astype(np.int64) - 1 for s in (2 * CODE_BITS, CODE_BITS, 0)]
    one, two = c[1] < 0, (c[0] < 0) & (c[1] >= 0)
    first = np.where(one, c[2], np.where(two, c[1], c[0]))
    second = np.where(one, -1, np.where(two, c[2], c[1]))
    return [first, second, np.where(c[0] < 0, -1, c[2])]


def _hashes(lang: str, words: pa.Array, keys: np.ndarray) -> np.ndarray:
    data, off = scan.flat(words)
    own = scan.range_hash(data, off[:-1], off[1:])
    own = np.append(own, U64(0))  # of number -1
    seed = U64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
    h = np.full(len(keys), seed)
    for lo in range(0, len(keys), PART):
        part = h[lo:lo + PART]
        for c, p in zip(_codes(keys[lo:lo + PART]), scan.powers(5)[1:]):
            part += own[c] * p
        part[:] = scan.mix(part)
    return h


def _place(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 bits within it."""
    return ((h >> U64(32)) % U64(buckets)).astype(np.int64), (h & U64(0xFFFFFFFF)).astype(np.uint32)


# ------------------------------------------------------------------- pass 1
def _partials(batches, buckets: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """One row (bucket, 4-byte phrase hashes, 1-byte counts up to the threshold) for each block and bucket."""
    for lang, words, keys, counts in _blocks(batches):
        bucket, low = _place(_hashes(lang, words, keys), buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, low, counts = bucket[order], low[order], np.minimum(counts[order], threshold).astype(np.uint8)
        ids, first = np.unique(bucket, return_index=True)
        ends = [*first[1:].tolist(), len(bucket)]
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()),
            pa.array([low[a:z].tobytes() for a, z in zip(first, ends)], pa.binary()),
            pa.array([counts[a:z].tobytes() for a, z in zip(first, ends)], pa.binary())], ["bucket", "low", "counts"])


class Summary:
    """Misra-Gries summary of one bucket: sorted keys with counters.

    ``taken`` is what the decrements have taken from any counter at most.  A
    capacity above mass / threshold keeps it below the threshold; should a
    summary meet more mass than it was made for, it grows instead.
    """

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold, self.taken = capacity, threshold, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.certain: list[np.ndarray] = []
        self._wait: list[tuple] = []
        self._n = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        sure = counts >= self.threshold
        if sure.any():
            self.certain.append(keys[sure])
        if len(self.certain) > 64:
            self.certain = [np.unique(np.concatenate(self.certain))]
        self._wait.append((keys[~sure], counts[~sure].astype(np.int64)))
        self._n += len(keys)
        if self._n >= self.capacity:
            self.merge()

    def merge(self) -> None:
        """Merge what waits and take from all counters what the capacity asks for."""
        keys = np.concatenate([self.keys, *(k for k, _ in self._wait)])
        counts = np.concatenate([self.counts, *(c for _, c in self._wait)])
        self._wait, self._n = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[at], np.add.reduceat(counts, at)
        if len(keys) > self.capacity:
            most = len(keys) - self.capacity - 1
            cut = min(int(np.partition(counts, most)[most]), self.threshold - 1 - self.taken)
            self.taken += cut
            counts = counts - cut
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def survivors(self) -> np.ndarray:
        """All keys that may have reached the threshold."""
        self.merge()
        return np.concatenate([*self.certain, self.keys[self.counts + self.taken >= self.threshold]])


def _segments(batches, capacity: int, threshold: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, bitmap of its survivors) from partial rows sorted by bucket."""
    at, s = None, None

    def row() -> pa.RecordBatch:
        flags = np.zeros(bits, dtype=bool)
        flags[s.survivors() % np.uint32(bits)] = True
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array(
            [np.packbits(flags, bitorder="little").tobytes()], pa.binary())], ["bucket", "bits"])

    for b in batches:
        for bucket, low, counts in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            if bucket != at:
                if s is not None:
                    yield row()
                at, s = bucket, Summary(capacity, threshold)
            s.add(np.frombuffer(low.as_buffer(), np.uint32), np.frombuffer(counts.as_buffer(), np.uint8))
    if s is not None:
        yield row()


# ------------------------------------------------------------------- pass 2
def _counted(batches, filter_, buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, count) of a block's phrases that pass the bitmap; null phrase: all its words."""
    flags = np.frombuffer(filter_.value, np.uint8)
    for lang, words, keys, counts in _blocks(batches):
        bucket, low = _place(_hashes(lang, words, keys), buckets)
        slot = bucket * bits + (low % np.uint32(bits))
        keep = (flags[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        first, second, third = _codes(keys[keep])
        n_words = 1 + (second >= 0).astype(np.int64) + (third >= 0)
        total = int(counts[keys <= CODE].sum())
        counts = counts[keep]
        for k in (1, 2, 3):
            at = np.flatnonzero(n_words == k)
            for lo in range(0, len(at), PART):
                part = at[lo:lo + PART]
                phrase = [words.take(pa.array(c[part])) for c in (first, second, third)[:k]]
                phrase = pc.binary_join_element_wise(*phrase, b" ") if k > 1 else phrase[0]
                yield _rows(lang, phrase.cast(pa.string()), k, counts[part])
        yield _rows(lang, pa.nulls(1, pa.string()), 0, np.array([total]))


def _rows(lang: str, phrase: pa.Array, k: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(phrase), pa.string()), phrase, pa.array(np.full(len(phrase), k), pa.int64()),
        pa.array(counts, pa.int64())], ["lang", "phrase", "words", "c"])


def phrase_counts(docs: DataFrame, threshold: int = 10, capacity: int = 1 << 20, filter_bits: int = 1 << 27) -> DataFrame:
    """(lang, phrase, words, f) of every phrase of one to three words that occurs
    ``threshold`` times or more in its lang; the row with a null phrase counts all words.

    ``capacity``: counters of a summary, which sets the number of buckets;
    ``filter_bits``: size of the bitmap that is broadcast (16 MB by default, at any input size).
    """
    if not 1 <= threshold <= 255:
        raise ValueError("the threshold must lie between 1 and 255")
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("decimal(38,0)")), F.lit(0))).first()[0]
    # a word takes two bytes with its separator, and starts three phrases at most
    mass = 3 * (int(n_bytes) // 2 + 1)
    buckets = max(1, -(-mass // (threshold * capacity)))
    bits = max(8, -(-filter_bits // buckets) + 7 & ~7)
    partial = texts.mapInArrow(lambda it: _partials(it, buckets, threshold), "bucket long, low binary, counts binary")
    segments = partial.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda it: _segments(it, capacity, threshold, bits), "bucket long, bits binary")
    flags = bytearray(buckets * bits // 8)
    for row in segments.collect():  # filter_bits in all
        flags[row.bucket * bits // 8:(row.bucket + 1) * bits // 8] = row.bits
    filter_ = spark.sparkContext.broadcast(bytes(flags))
    rows = texts.mapInArrow(lambda it: _counted(it, filter_, buckets, bits), "lang string, phrase string, words long, c long")
    return rows.groupBy("lang", "phrase", "words").agg(F.sum("c").alias("f")).filter(
        F.col("phrase").isNull() | (F.col("f") >= threshold))


# ----------------------------------------------------------------- scoring
def _score(a: str, l: str, r: str) -> str:
    """floor(1000000 * a * a / (l * r)) in decimals: exact for counts below 10**16."""
    d = lambda c: f"cast({c} as decimal(16,0))"
    return f"(cast(1000000 as decimal(7,0)) * ({d(a)} * {d(a)})) div ({d(l)} * {d(r)})"


def collocations(docs: DataFrame, threshold: int = 10, inside_pct: int = 50, top: int = 2000, **sizes) -> DataFrame:
    """The ``top`` phrases of two or three words of each lang: lang, rank, phrase, a, l, r, n, score.

    A phrase is scored by its weakest cut into two parts; one that lies inside
    a longer phrase with at least ``inside_pct`` percent of its occurrences is dropped.
    """
    counts = materialise(phrase_counts(docs, threshold, **sizes), "phrase-counts")
    known = counts.filter("phrase is not null").select("lang", "phrase", "words", "f")
    cand = known.filter("words >= 2").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    two = lambda i, j: f"concat_ws(' ', w[{i}], w[{j}])"
    cuts = cand.selectExpr("lang", "phrase", "a", f"""explode(if(words = 2,
        array(struct('l1' as part, w[0] as of), struct('r1' as part, w[1] as of)),
        array(struct('l1' as part, w[0] as of), struct('r1' as part, {two(1, 2)} as of),
              struct('l2' as part, {two(0, 1)} as of), struct('r2' as part, w[2] as of)))) as cut""")
    part = cuts.selectExpr("lang", "phrase", "a", "cut.part", "cut.of").join(
        known.selectExpr("lang", "phrase as of", "f"), ["lang", "of"])
    pick = lambda p: F.max(F.when(F.col("part") == p, F.col("f"))).alias(p)
    cut = part.groupBy("lang", "phrase", "a").agg(*(pick(p) for p in ("l1", "r1", "l2", "r2")))
    cut = cut.selectExpr("lang", "phrase", "a", "l1", "r1", "l2", "r2", f"{_score('a', 'l1', 'r1')} as s1",
                         f"{_score('a', 'l2', 'r2')} as s2")
    second = "(s2 is not null and s2 < s1)"
    scored = cut.selectExpr("lang", "phrase", "a", f"if({second}, l2, l1) as l", f"if({second}, r2, r1) as r",
                            f"if({second}, s2, s1) as score")
    longer = cand.filter("words = 3").selectExpr(
        "lang", "a as longer", f"explode(array({two(0, 1)}, {two(1, 2)})) as phrase").groupBy("lang", "phrase").agg(
        F.max("longer").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(
        f"longer is null or 100 * longer < {inside_pct} * a").drop("longer")
    order = "order by score desc, a desc, phrase"
    # the best of each slice of a lang first, so that no task sorts a whole lang
    best = left.withColumn("slice", F.expr("pmod(xxhash64(phrase), 64)")).selectExpr(
        "*", f"row_number() over (partition by lang, slice {order}) as place").filter(f"place <= {top}").drop("place", "slice")
    ranked = best.selectExpr("*", f"cast(row_number() over (partition by lang {order}) as long) as rank").filter(f"rank <= {top}")
    total = counts.filter("phrase is null").selectExpr("lang", "f as n")
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
