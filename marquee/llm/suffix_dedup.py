r"""Removal of repeated byte strings by blockwise suffix sorting (operator 8).

Every byte that lies in a ``length``-byte string which also starts anywhere
else (in any document, the same one included) is removed; texts are judged
as given.  Exact, and no suffix of the whole corpus is ever shuffled:

1. *Suffix buckets.*  Each ``length``-byte string is filed under its anchor,
   the 32-byte gram with the smallest hash in it, so equal strings have equal
   anchors at equal offsets.  The strings of an anchor form two families
   (starting far before it, or near it); all strings of a family hold the same
   core of about half the length, whose hash names the bucket.  The bytes
   that a document's strings of one bucket span are a *context*.  A bucket
   needs about one row for 120 bytes of text.
2. Equal contexts of a bucket are counted together (with partial sums before
   the shuffle, so thousands of copies are one row).  A context seen twice is
   repeated as a whole; a bucket with a single context is finished.
3. *Suffix sorting.*  The distinct contexts of the other buckets are read
   from the texts and sorted block by block: suffixes are ranked by their
   first 32 bytes, ranks over longer prefixes are kept only for a sample of
   the positions (a difference cover modulo 32) and long ties between any two
   suffixes are resolved by the sample ranks at the offset that both share.
   Memory is bounded by the block.
4. A bucket with more than ``max_contexts`` distinct contexts (a very common
   passage with different surroundings) is not gathered: its strings are
   counted by digest in an aggregation instead, with the same result.
5. The repeated strings' byte ranges return to the documents by a join.
6. With ``words``, strings of that many words (`[^\x20\x09-\x0D]+`, whatever
   stands between them) which occur twice go as well, from their first to
   their last byte: the same steps run on the words' 64-bit hashes, so that
   ``CODE`` bytes stand for a word.

Ranks compare the bytes themselves; buckets, equal contexts and step 4 rest
on hashes of 128 bits in total.  Null texts count as empty.  Rows with the
same doc_id and text are separate documents that repeat each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm import scan
from marquee.llm.common import drop_table, free_shuffles, materialise, ship

GRAM = 32
#: bytes that stand for a word where strings of words are looked for
CODE = 8
COVER_MOD = 32
BLOCK_BYTES = 1 << 20


# ---------------------------------------------------------- 1. suffix buckets
def _doubled(data: np.ndarray, upto: int) -> dict[int, np.ndarray]:
    """Hashes of the 1, 2, 4, ... ``upto`` bytes that start at each position."""
    h, out, n = scan.BYTE_VALUE[data], {}, 1
    while n < upto:
        step = scan.powers(n + 2)[n + 1]
        h = h[:-n] * step + h[n:] if len(h) > n else h[:0]
        n *= 2
        if n in (GRAM, upto):
            out[n] = h
    return out


def _sliding_argmin(v: np.ndarray, w: int) -> np.ndarray:
    """Position of the smallest of each ``w`` neighbours (the first on ties)."""
    bits = max(1, int(len(v)).bit_length())
    low = np.uint64((1 << bits) - 1)
    key = (v & ~low) | np.arange(len(v), dtype=np.uint64)
    m = -(-len(v) // w) * w
    full = np.full(m, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:len(v)] = key
    blocks = full.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(v) - w + 1
    return (np.minimum(after[:n], before[w - 1:w - 1 + n]) & low).astype(np.int64)


def _range_hash(h: np.ndarray, unit: int, start: np.ndarray, ln: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges at least ``unit`` long from the unit hashes ``h``."""
    out = ln.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    last = start + ln - unit
    for j in range(-(-int(ln.max()) // unit)):
        out = scan.mix(out ^ h[np.minimum(start + j * unit, last)])
    return out


def _anchors(data: np.ndarray, off: np.ndarray, length: int):
    """Contexts of a slice: (row, bucket, context hash, anchor, first, last);
    anchor in its document, first and last start relative to the anchor."""
    none = [np.zeros(0, np.int64)] * 6
    w = length - GRAM + 1
    split = w // 2
    unit = 1 << (min(length - split, split + GRAM + 1).bit_length() - 1)
    if len(data) < length:
        return none
    h = _doubled(data, max(unit, GRAM))
    at = _sliding_argmin(scan.mix(h[GRAM]), w)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(at)]
    start = np.flatnonzero(np.arange(len(at)) + length <= off[doc + 1])
    if not len(start):
        return none
    a, d = at[start], doc[start]
    near = start - a >= -split
    new = np.ones(len(start), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1]) | (near[1:] != near[:-1])
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(start)) - 1
    a, d, near, s0, s1 = a[i], d[i], near[i], start[i], start[j]
    core = np.where(near, a, a - split - 1)
    ln = np.where(near, length - split, split + 1 + GRAM)
    u = h[unit]
    bucket = scan.mix(_range_hash(u, unit, core, ln) + near.astype(np.uint64))
    ctx = scan.mix(_range_hash(u, unit, s0, s1 - s0 + length)
                   + (a - s0).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return d, bucket.view(np.int64), ctx.view(np.int64), a - off[d], s0 - a, s1 - a


def _codes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes as bytes, with offsets."""
    w = scan.words(data, off)
    return w.hash.astype("<u8").view(np.uint8), CODE * w.first


def _context_rows(batches, length: int, coded: bool = False) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rid, th = (b.column(b.schema.get_field_index(c)) for c in ("rid", "th"))
        for lo, hi, data, off in scan.slices(b.column(b.schema.get_field_index("text"))):
            if coded:
                data, off = _codes(data, off)
            d, bucket, ctx, a, r0, r1 = _anchors(data, off, length)
            row = pa.array(d + lo)
            yield pa.RecordBatch.from_arrays(
                [rid.take(row), th.take(row), pa.array(bucket), pa.array(ctx), pa.array(a, pa.int64()),
                 pa.array(r0.astype(np.int32)), pa.array(r1.astype(np.int32))],
                ["rid", "th", "bucket", "ctx", "anchor", "r0", "r1"])


# --------------------------------------------- 3. difference-cover suffix sort
def _difference_cover(v: int) -> list[int]:
    """A small set whose pairwise differences cover all residues modulo v."""
    cover, open_ = [0], set(range(1, v))
    while open_:
        best = max((c for c in range(v) if c not in cover),
                   key=lambda c: len(open_ & {(c - x) % v for x in cover} | open_ & {(x - c) % v for x in cover}))
        cover.append(best)
        open_ -= {(x - y) % v for x in cover for y in cover}
    return sorted(cover)


COVER = np.zeros(COVER_MOD, dtype=bool)
COVER[_difference_cover(COVER_MOD)] = True
#: smallest shift that brings both residues into the cover
SHIFT = np.array([[next(s for s in range(COVER_MOD) if COVER[(i + s) % COVER_MOD] and COVER[(j + s) % COVER_MOD])
                   for j in range(COVER_MOD)] for i in range(COVER_MOD)])


def _rank(a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
    """Dense ranks of values, or of pairs of ranks."""
    key = a if b is None else (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    return np.unique(key, return_inverse=True)[1].astype(np.uint32)


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``starts`` begin a ``length``-byte string that begins at
    another one of them, too."""
    half = COVER_MOD
    while 2 * half < length:
        half *= 2
    if half > length - COVER_MOD + 1:
        raise ValueError(f"length {length}: use one between {COVER_MOD * 2} and more with a power of two in its upper half")
    n = len(text)
    pad = np.zeros(n + 2 * half + 2 * COVER_MOD, dtype=np.uint8)
    pad[:n] = text
    # suffixes ranked by their first 32 bytes: 8 bytes as a number, then doubled
    word = np.zeros(len(pad) - 7, dtype=np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | pad[k:len(pad) - 7 + k]
    r = _rank(word)
    for step in (8, 16):
        r = _rank(r[:-step], r[step:])
    # longer prefixes for the cover sample only; x and x + step are both in it
    pos = np.flatnonzero(COVER[np.arange(len(r)) % COVER_MOD])
    index = np.full(len(r), -1, dtype=np.int64)
    index[pos] = np.arange(len(pos))
    s, step = r[pos], COVER_MOD
    while step < half:
        beyond = pos + step < len(r)
        other = np.zeros(len(pos), dtype=np.uint32)
        other[beyond] = s[index[pos[beyond] + step]] + np.uint32(1)
        s, step = _rank(s, other), step * 2

    def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal ``length`` bytes, given equal first and last 32."""
        out = np.ones(len(i), dtype=bool)
        for at in (0, length - half - COVER_MOD + 1):
            x, y = i + at, j + at
            d = SHIFT[x % COVER_MOD, y % COVER_MOD]
            out &= s[index[x + d]] == s[index[y + d]]
        return out

    key = (r[starts].astype(np.uint64) << np.uint64(32)) | r[starts + length - COVER_MOD]
    order = np.argsort(key, kind="stable")
    left, key = order, key[order]
    out = np.zeros(len(starts), dtype=bool)
    while len(left):
        # ties on both ends: compare each with the first of its group
        first = np.ones(len(left), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        head = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        equal = same(starts[left], starts[left[head]][group])
        size = np.bincount(group[equal], minlength=len(head))
        out[left[equal & (size[group] > 1)]] = True
        left, key = left[~equal], key[~equal]
    return out


def _sort_block(block: pa.Table, length: int) -> pa.RecordBatch:
    """Contexts of whole buckets (bucket, ctx, r0, bytes) -> repeated ranges."""
    bucket, ctx, r0 = (block.column(c).to_numpy() for c in ("bucket", "ctx", "r0"))
    text, off = scan.flat(block.column("bytes").combine_chunks())
    count = np.diff(off) - length + 1
    owner = np.repeat(np.arange(len(count)), count)
    within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    hit = repeated_starts(text, off[owner] + within, length)
    s, e = scan.runs(hit, np.concatenate([[0], np.cumsum(count)]))
    own = owner[s]
    r = r0[own] + within[s]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[own]), pa.array(ctx[own]), pa.array(r, pa.int32()), pa.array(r + (e - s) - 1, pa.int32())],
        ["bucket", "ctx", "f0", "f1"])


def _sort_blocks(batches, length: int) -> Iterator[pa.RecordBatch]:
    """Buckets arrive together and sorted; small ones share a block."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b.select(["bucket", "ctx", "r0", "bytes"])])
        held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
        if held.num_rows:
            # the last bucket may go on in the next batch
            bucket = held.column("bucket").to_numpy()
            whole = int(np.searchsorted(bucket, bucket[-1]))
            yield from _in_blocks(held.slice(0, whole), length)
            held = held.slice(whole)
    if held is not None:
        yield from _in_blocks(held, length)


def _in_blocks(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Whole buckets, sorted, in blocks of some ``BLOCK_BYTES``, one bucket at least."""
    if not rows.num_rows:
        return
    bucket = rows.column("bucket").to_numpy()
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    size = np.cumsum(pc.binary_length(rows.column("bytes")).to_numpy())
    upto = size[np.append(first[1:], len(bucket)) - 1]     # bytes up to the end of each bucket
    block = np.append(0, upto[:-1]) // BLOCK_BYTES
    edges = [*first[np.append(True, block[1:] != block[:-1])].tolist(), len(bucket)]
    for lo, hi in zip(edges[:-1], edges[1:]):
        yield _sort_block(rows.slice(lo, hi - lo), length)


# ------------------------------------------------------------------ the join
def _pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.BinaryArray:
    """The bytes of each range."""
    size = np.maximum(end - start, 0)
    upto = np.concatenate([[0], np.cumsum(size)])
    out = data[np.repeat(start - upto[:-1], size) + np.arange(int(upto[-1]))]
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(out)])


def _cut_contexts(batches, length: int, coded: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows (text, wanted: list of bucket, ctx, anchor, r0, r1) -> bytes."""
    for b in batches:
        wanted = b.column(b.schema.get_field_index("wanted"))
        for lo, hi, data, off in scan.slices(b.column(b.schema.get_field_index("text"))):
            if coded:
                data, off = _codes(data, off)
            part = wanted.slice(lo, hi - lo)
            doc = np.repeat(np.arange(hi - lo), np.diff(np.asarray(part.offsets, dtype=np.int64)))
            rows = part.flatten()
            bucket, ctx, anchor, r0, r1 = (np.asarray(rows.field(i)) for i in range(5))
            first = np.minimum(off[doc] + anchor + r0, off[doc + 1])
            last = np.minimum(off[doc] + anchor + r1 + length, off[doc + 1])
            for i in range(0, len(doc), 4000):
                j = slice(i, i + 4000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[j]), pa.array(ctx[j]), pa.array(r0[j], pa.int32()), pa.array(r1[j], pa.int32()),
                     _pieces(data, first[j], last[j])], ["bucket", "ctx", "r0", "r1", "bytes"])


def _identified(docs: DataFrame, *more: str) -> DataFrame:
    """Rows are told apart by document id and text hash."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("rid"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), *more)


def repeated_ranges(docs: DataFrame, length: int = 400, max_contexts: int = 4096) -> DataFrame:
    """docs (doc_id, text) -> (rid, th, spans): byte ranges [start, end) of
    repeated strings per document, unsorted and overlapping."""
    ship(docs.sparkSession)
    return _ranges(_identified(docs, "text").filter(F.octet_length("text") >= length), length, max_contexts)[0]


def repeated_words(docs: DataFrame, words: int, max_contexts: int = 4096) -> DataFrame:
    """docs (doc_id, text) -> (rid, th, word_spans): ranges [start, end) of
    repeated strings of ``words`` words, in bytes of the words' codes."""
    ship(docs.sparkSession)
    base = _identified(docs, "text").filter(F.octet_length("text") >= 2 * words - 1)
    return _written(*_ranges(base, CODE * words, max_contexts, coded=True)).withColumnRenamed("spans", "word_spans")


def _written(spans: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """``spans`` as a table of its own; those it was made from go."""
    out = materialise(spans, "suffix-spans")
    for t in tables:
        drop_table(t.sparkSession, t)
    del spans
    tables.clear()
    free_shuffles(out.sparkSession)
    return out


def _ranges(base: DataFrame, length: int, max_contexts: int, coded: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """base (rid, th, text) -> (rid, th, spans) and the scratch tables it reads;
    ``coded``: ranges of the words' codes instead of the texts."""
    rows = materialise(base.mapInArrow(
        lambda it: _context_rows(it, length, coded),
        "rid long, th long, bucket long, ctx long, anchor long, r0 int, r1 int"), "suffix-rows")
    seen = materialise(rows.groupBy("bucket", "ctx").agg(
        F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("rid", "th", "anchor", "r0", "r1"))), "suffix-contexts")
    many = seen.groupBy("bucket").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    open_ = seen.join(many, "bucket")
    wanted = open_.groupBy("rid", "th").agg(F.collect_list(
        F.struct("bucket", "ctx", "anchor", "r0", "r1")).alias("wanted"))
    cut = (base.join(wanted, ["rid", "th"]).select("text", "wanted")
           .mapInArrow(lambda it: _cut_contexts(it, length, coded),
                       "bucket long, ctx long, r0 int, r1 int, bytes binary")
           # rows with equal ids and texts give the same contexts
           .dropDuplicates(["bucket", "ctx"]))
    cut = materialise(cut.join(many, "bucket"), "suffix-cut")
    free_shuffles(base.sparkSession)
    found = (cut.filter(F.col("contexts") <= max_contexts).drop("contexts")
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(lambda it: _sort_blocks(it, length), "bucket long, ctx long, f0 int, f1 int"))
    # very common buckets: each string by its digest
    strings = (cut.filter(F.col("contexts") > max_contexts)
               .select("bucket", "ctx", F.explode(F.sequence("r0", "r1")).alias("r"), "r0", "bytes")
               .select("bucket", "ctx", "r", F.md5(F.substring("bytes", F.col("r") - F.col("r0") + 1, F.lit(length))).alias("digest")))
    twice = strings.groupBy("bucket", "digest").agg(F.count("*").alias("c")).filter("c > 1")
    common = strings.join(twice, ["bucket", "digest"]).select(
        "bucket", "ctx", F.col("r").alias("f0"), F.col("r").alias("f1"))
    whole = seen.filter("copies > 1").select("bucket", "ctx", F.col("r0").alias("f0"), F.col("r1").alias("f1"))
    flagged = found.unionByName(common).unionByName(whole)
    hits = rows.select("rid", "th", "bucket", "ctx", "anchor").join(flagged, ["bucket", "ctx"])
    # a set: copies of one row (equal id and text) find the same ranges
    return hits.groupBy("rid", "th").agg(F.collect_set(F.struct(
        (F.col("anchor") + F.col("f0")).alias("start"), (F.col("anchor") + F.col("f1") + length).alias("end"))).alias("spans")
    ), [rows, seen, cut]


SPANS = ("_spans", "_word_spans")


def _listed(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the ranges of each row (null: none)."""
    size = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    flat = spans.flatten()
    return np.repeat(np.arange(len(spans)), size), *(np.asarray(flat.field(i), dtype=np.int64) for i in (0, 1))


def _bytes_of(data: np.ndarray, off: np.ndarray, row: np.ndarray, a: np.ndarray, b: np.ndarray, words: int):
    """Ranges of word codes as byte ranges of the texts; equal bytes of a word
    that differs, before or after the words, do not count."""
    start, end = scan.runs(~scan.SPACE[data], off)
    a, b = -(-a // CODE), b // CODE
    on = b - a >= words
    row, a, b = row[on], a[on], b[on]
    first = np.searchsorted(start, off)[row]
    return row, start[first + a] - off[row], end[first + b - 1] - off[row]


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each row sorted, disjoint and not touching."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    room = int(end.max()) + 1
    reach = np.maximum.accumulate(row * room + end)
    i = np.flatnonzero(np.append(True, row[1:] * room + start[1:] > reach[:-1]))
    j = np.append(i[1:], len(row)) - 1
    return row[i], start[i], reach[j] - row[i] * room


def _cut(data: np.ndarray, off: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What is left of the texts, with offsets."""
    edge = np.bincount(off[row] + start, minlength=len(data) + 1) - np.bincount(off[row] + end, minlength=len(data) + 1)
    left = np.cumsum(edge)[:-1] == 0
    return data[left], np.concatenate([[0], np.cumsum(left)])[off]


def _texts(rest: np.ndarray, off: np.ndarray, null: np.ndarray) -> pa.Array:
    """A cut inside a code point leaves bytes that are no text."""
    raw, begin = rest.tobytes(), off[:-1][np.diff(off) > 0]
    try:
        raw.decode("utf-8")
        valid = not ((rest[begin] & 0xC0) == 0x80).any()
    except UnicodeDecodeError:
        valid = False
    if valid:
        return pa.Array.from_buffers(pa.string(), len(null), [
            pa.py_buffer(np.packbits(~null, bitorder="little")), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(raw)])
    return pa.array([None if x else raw[a:b].decode("utf-8", "ignore") for x, a, b in zip(null, off[:-1], off[1:])], pa.string())


def _apply(batches, words: int, apart: bool) -> Iterator[pa.RecordBatch]:
    """``RESULTS`` of each row; ``apart``: figures and hash without the word spans."""
    for b in batches:
        row, text, spans, coded = (b.column(b.schema.get_field_index(c)) for c in ("row", "text", *SPANS))
        for lo, hi, data, off in scan.slices(text):
            n = hi - lo
            own = _listed(spans.slice(lo, n))
            every = [np.concatenate(x) for x in zip(own, _bytes_of(data, off, *_listed(coded.slice(lo, n)), words))] if words else own
            every = merged(*every)
            own = merged(*own) if apart else every
            rest, at = _cut(data, off, *own)
            raw, null = rest.tobytes(), np.array(text.slice(lo, n).is_null())
            kept = _texts(rest, at, null)
            yield pa.RecordBatch.from_arrays(
                [row.slice(lo, n), pa.array(np.diff(off)), pa.array(np.diff(off) - np.diff(at)),
                 pa.array(np.bincount(own[0], minlength=n).astype(np.int64)),
                 pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(at[:-1].tolist(), at[1:].tolist())], pa.string()),
                 kept, _texts(*_cut(data, off, *every), null) if apart and words else kept],
                ["row", *RESULTS])


RESULTS = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "sha256": "string", "kept": "string",
           "kept_words": "string"}


def suffix_dedup(docs: DataFrame, length: int = 400, kept_text: bool = True, max_contexts: int = 4096,
                 words: int = 0, apart: bool = False, mark: str = "_") -> DataFrame:
    """docs with ``text`` replaced by _n_bytes, _n_removed, _n_spans and
    _kept: the remaining text, or its sha256 if ``kept_text`` is false.

    With ``words``, repeated strings of so many words go besides those of
    ``length`` bytes.  ``apart`` keeps the two rules apart: the figures,
    _sha256 and _kept are those of the byte rule, and _kept_words is the text
    that both rules leave.

    ``doc_id`` is a long.  Rows of equal id and text are copies and lose the
    same ranges; an empty table gives an empty one.  Columns of ``docs`` may
    have any names but those that ``mark`` gives the results.
    """
    if words:
        ship(docs.sparkSession)
        # no name is left for the first pass's plan, so that its shuffle files can go before the second
        spans = _written(*_ranges(_identified(docs, "text").filter(F.octet_length("text") >= length), length, max_contexts)).join(repeated_words(docs, words, max_contexts), ["rid", "th"], "full")
    else:
        spans = repeated_ranges(docs, length, max_contexts).withColumn("word_spans", F.lit(None).cast(
            "array<struct<start:long,end:long>>"))
    spans = spans.select("rid", "th", F.col("spans").alias("_spans"), F.col("word_spans").alias("_word_spans"))
    # the other columns travel as one, so that their names meet none of these
    row = F.struct(*[c for c in docs.columns if c != "text"])
    joined = _identified(docs, "text", row.alias("row")).join(spans, ["rid", "th"], "left").drop("rid", "th")
    schema = T.StructType([joined.schema["row"], *(
        T.StructField(c, T.LongType() if kind == "long" else T.StringType()) for c, kind in RESULTS.items())])
    out = joined.mapInArrow(lambda it: _apply(it, words, apart), schema)
    named = [F.col(c).alias(f"{mark}{c}") for c in ("n_bytes", "n_removed", "n_spans")]
    if apart:
        named += [F.col(c).alias(f"{mark}{c}") for c in ("sha256", "kept", "kept_words")]
    else:
        named.append(F.col("kept" if kept_text else "sha256").alias(f"{mark}kept"))
    return out.select("row.*", *named)
