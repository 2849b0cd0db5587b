"""SentencePiece encoding and decoding by a relational lattice (operator 3).

The piece table (a public BPE model with byte fallback; its path is a
parameter) is a table with one row per piece.  Encoding runs over the distinct
*segments* of all texts:

* a segment is a run of blanks with the run of characters behind it that some
  piece can hold side by side; no piece crosses its ends, which is read off the
  piece table (characters that are neighbours in a piece are of one class);
* every segment is exploded into its substrings up to the longest piece, these
  are equi-joined to the piece table, and the *edges* (end, length, piece) are
  grouped by segment.  Segments are dealt by their key, so only they are
  shuffled and never the edges;
* Spark's ``aggregate`` folds the edges in the order of their ends and keeps the
  last piece of the best path to every position.  A BPE encoding is the one
  path in which every two adjacent pieces are what merging their concatenation
  would give, so the score of a step is whether its pair of pieces is stable;
  exactly one edge per position survives and the ids equal the model's own.  A
  second fold walks back from the end.

The ids go back to the texts by segment: the most frequent segments (at most
``hot``, of at most ``HOT_IDS`` pieces) are broadcast, the others, of which none
is frequent, are joined by key and gathered per text.  Keys of segments and of
texts have 128 bits; a task finds a segment among the broadcast ones by 64.

Whether a pair is stable follows from the two merge trees (:class:`Pairs`).  A
character without a piece is its UTF-8 bytes as byte pieces.  Decoding joins the
pieces' bytes and drops the first blank.  U+2581, the model's own sign for a
blank, decodes to a blank, as in the library; every other text returns unchanged.

A null text has null ids; an empty text has none; repeated rows return once each;
an empty table gives an empty one.  Other columns pass unchanged, but for those
named like a result column, which the result replaces.  Pieces may have up to 16
characters; a piece table with longer ones is refused.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from marquee.llm import scan
from marquee.llm.common import drop_table, free_shuffles, materialise, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = 0x2581
#: a character without a piece is an edge with this flag and its code point
UNKNOWN = 1 << 21
ID_BITS = 22
LONGEST = 16
#: broadcast segments and the pieces of one of them
HOT, HOT_IDS = 1 << 19, 32
#: characters of a window; edges of one inner fold
WINDOW, BLOCK = 256, 1024
#: texts with more copies than COPIES are dealt over SALTS tasks, the COPIED most frequent ones
COPIES, COPIED, SALTS = 256, 1000, 64
#: code points of distinct segments that a task holds
HELD = 1 << 22
NEVER = 1 << 30
U64 = np.uint64
#: powers of the inverse of the step of scan.powers
_back = np.ones(1, dtype=U64)


def piece_table(path: str = MODEL) -> list[tuple[int, str, float, int]]:
    """(id, piece, score, byte or -1) of the pieces that texts are made of."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = []
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            rows.append((i, sp.id_to_piece(i), 0.0, int(sp.id_to_piece(i)[3:-1], 16)))
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            rows.append((i, sp.id_to_piece(i), sp.get_score(i), -1))
    return rows


def merges(text: str, rank: dict[str, int]) -> list[tuple[int, int, int, int]]:
    """Merging of a text, best rank first, leftmost on ties: (rank, start, middle, end)."""
    end = {i: i + 1 for i in range(len(text))}   # symbol by its start
    start = {i + 1: i for i in range(len(text))}
    heap: list[tuple[int, int, int, int]] = []

    def push(a, m):
        if a is not None and m in end and (r := rank.get(text[a:end[m]])) is not None:
            heapq.heappush(heap, (r, a, m, end[m]))

    for i in range(len(text) - 1):
        push(i, i + 1)
    done = []
    while heap:
        r, a, m, e = heapq.heappop(heap)
        if end.get(a) != m or end.get(m) != e:
            continue
        del end[m]
        end[a], start[e] = e, a
        done.append((r, a, m, e))
        push(start.get(a), a)
        push(a, e)
    return done


class Pairs:
    """Which pairs of pieces are stable, that is, merge to themselves side by side.

    Each half merges as it would alone until a merge crosses the border.  The
    symbols that ever touch the border are one chain in each half.  A symbol
    comes at a ``level`` (the worst rank that its half has merged by then) and is
    ``held`` until the worst rank between its coming and its own merge.  A
    crossing merge of ``a`` and ``b`` happens when its rank and the level of each
    come before the other is gone; on ties the left goes first.
    """

    def __init__(self, table: list[tuple[int, str, float, int]]):
        rows = sorted((-s, i, p) for i, p, s, b in table if b < 0)
        rank = {p: k for k, (_, _, p) in enumerate(rows)}
        self.id = {p: i for _, i, p in rows}
        n = max(i for i, *_ in table) + 1
        head, tail, depth = {}, {}, 1
        for p, i in list(self.id.items()):
            done = merges(p, rank)
            if len(done) < len(p) - 1:
                del self.id[p]      # merging never makes this piece
                continue
            for chains, edge in ((head, 1), (tail, 3)):
                at = 0 if edge == 1 else len(p)
                chain, level, since, size = [], -1, -1, 1
                begun = -1
                for r, a, m, e in done:
                    level, since = max(level, r), max(since, r)
                    if (a if edge == 1 else e) == at:
                        chain.append((p[:size] if edge == 1 else p[-size:], begun, since))
                        size, begun, since = e - a, level, -1
                chain.append((p, begun, NEVER))
                chains[i] = chain
                depth = max(depth, len(chain))
        self.head, self.tail = (self._grid(c, n, depth) for c in (head, tail))
        key, val = [], []
        for p, k in rank.items():
            for c in range(1, len(p)):
                if p[:c] in self.id and p[c:] in self.id:
                    key.append(self.id[p[:c]] << 21 | self.id[p[c:]])
                    val.append(k)
        order = np.argsort(key)
        self.key, self.rank = np.array(key, np.int64)[order], np.array(val, np.int64)[order]
        self.known, self.stable = np.zeros(0, np.int64), np.zeros(0, bool)

    def _grid(self, chains, n, depth):
        grid = np.full((3, depth, n), -1, dtype=np.int32)
        for i, chain in chains.items():
            for d, (p, level, held) in enumerate(chain):
                grid[:, d, i] = self.id.get(p, -1), level, held
        return grid

    def decide(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        ok = np.ones(len(left), dtype=bool)
        for i in range(self.tail.shape[1]):
            a, la, ka = self.tail[:, i, left]
            for j in range(self.head.shape[1]):
                on = np.flatnonzero(ok & (a >= 0) & (self.head[0, j, right] >= 0))
                if not len(on) or not len(self.key):
                    continue
                b, lb, kb = self.head[:, j, right[on]]
                k = a[on].astype(np.int64) << 21 | b
                at = np.searchsorted(self.key, k)
                at[at == len(self.key)] = 0
                r = self.rank[at]
                bad = (self.key[at] == k) & (np.maximum(r, lb) < ka[on]) & (np.maximum(r, la[on]) <= kb)
                ok[on[bad]] = False
        return ok

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Stability of pairs, remembered; forgotten beyond some 4 million."""
        uniq, inv = np.unique(left.astype(np.int64) << 21 | right, return_inverse=True)
        at = np.searchsorted(self.known, uniq)
        miss = np.ones(len(uniq), dtype=bool)
        inside = at < len(self.known)
        miss[inside] = self.known[at[inside]] != uniq[inside]
        if miss.any():
            if len(self.known) > 4_000_000:
                self.known, self.stable = np.zeros(0, np.int64), np.zeros(0, bool)
                return self(left, right)
            new = uniq[miss]
            self.known = np.insert(self.known, at[miss], new)
            self.stable = np.insert(self.stable, at[miss], self.decide(new >> 21, new & (UNKNOWN - 1)))
            at = np.searchsorted(self.known, uniq)
        return self.stable[at][inv]


def _key(sums: np.ndarray, first: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Keys of segments from sums that count a segment's n-th code point by power ``first`` + n."""
    global _back
    if len(first) and len(_back) <= first[-1]:
        n = max(int(first[-1]) + 1, 2 * len(_back))
        step = np.full(n, pow(int(scan.powers(2)[1]), -1, 1 << 64), dtype=U64)
        step[0] = 1
        _back = np.cumprod(step, dtype=U64)
    return scan.mix(sums * _back[first] + width.astype(U64)).view(np.int64)


class Pieces:
    """What tasks need of a piece table besides the join: classes, bytes and pairs."""

    def __init__(self, table: list[tuple[int, str, float, int]]):
        self.table = table
        self.pairs: Pairs | None = None
        root: dict[str, str] = {}

        def find(c):
            while root.setdefault(c, c) != c:
                c = root[c]
            return c

        for _, p, _, b in table:
            rest = p.lstrip(chr(BLANK))
            if b < 0 and (chr(BLANK) in rest or len(p) > LONGEST):
                raise ValueError(f"piece {p!r}: a blank behind another character, or over {LONGEST} characters")
            for x, y in zip(rest, rest[1:]) if b < 0 else ():
                root[find(x)] = find(y)
        number: dict[str, int] = {}
        self.cls = np.zeros(0x110000, dtype=np.int32)   # 0: no neighbours in any piece
        for c in list(root):
            self.cls[ord(c)] = number.setdefault(find(c), len(number) + 1)
        every = np.arange(len(self.cls), dtype=U64)
        self.value = [scan.mix(every + U64(k)) for k in (1, 0x2545F4914F6CDD1D)]
        size = max(i for i, *_ in table) + 1
        self.byte_id = np.zeros(256, dtype=np.int64)
        raw = [b""] * size
        for i, p, _, b in table:
            raw[i] = bytes([b]) if b >= 0 else p.replace(chr(BLANK), " ").encode()
            if b >= 0:
                self.byte_id[b] = i
        self.raw_size = np.array([len(x) for x in raw], dtype=np.int64)
        self.raw_at = np.cumsum(self.raw_size) - self.raw_size
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)

    def segments(self, data: np.ndarray, off: np.ndarray):
        """Code points of UTF-8 texts, each not empty one behind a blank, and their segments:
        first code point, length and first half of the key; where each text's segments end."""
        size = np.diff(off) + (np.diff(off) > 0)
        raw = np.insert(data, off[np.flatnonzero(off[1:] > off[:-1])], 0x20)
        cp = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).copy()
        none = np.zeros(0, np.int64)
        if not len(cp):
            return cp, none, none, none, np.zeros(len(off), np.int64)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        edge = chars[np.concatenate([[0], np.cumsum(size)])]
        cp[cp == 0x20] = BLANK
        blank = cp == BLANK
        cls = self.cls[cp]
        new = np.ones(len(cp), dtype=bool)
        new[1:] = np.where(blank[1:], ~blank[:-1], ~blank[:-1] & ((cls[1:] != cls[:-1]) | (cls[1:] == 0)))
        new[edge[:-1][np.diff(edge) > 0]] = True
        first = np.flatnonzero(new)
        width = np.diff(np.append(first, len(cp)))
        key = np.add.reduceat(self.value[0][cp] * scan.powers(len(cp)), first)
        return cp, first, width, _key(key, first, width), np.searchsorted(first, edge)

    def second(self, cp: np.ndarray, first: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The other half of the key of some segments, and their code points."""
        if not len(first):
            return np.zeros(0, np.int64), cp[:0]
        at = np.cumsum(width) - width
        pos = np.repeat(first - at, width) + np.arange(int(width.sum()))
        part = cp[pos]
        return _key(np.add.reduceat(self.value[1][part] * scan.powers(len(cp))[pos], at), first, width), part

    def masks(self, edges: pa.ListArray) -> pa.ListArray:
        """Edges (start, length, piece) of each segment in the order of their ends, with
        the lengths of the pieces before them that make a stable pair, as bits."""
        self.pairs = self.pairs or Pairs(self.table)
        off = np.asarray(edges.offsets, dtype=np.int64)
        v = np.asarray(edges.values, dtype=np.int64)[off[0]:off[-1]]
        off = off - off[0]
        w = np.repeat(np.arange(len(off) - 1), np.diff(off))
        start, ln, piece = v >> 26, (v >> ID_BITS & 15) + 1, v & ((1 << ID_BITS) - 1)
        end = start + ln
        order = np.lexsort((end, w))
        w, start, ln, piece, end = (x[order] for x in (w, start, ln, piece, end))
        base = np.zeros(len(off) - 1, dtype=np.int64)
        if len(w):
            n = np.zeros(len(off) - 1, dtype=np.int64)
            np.maximum.at(n, w, end)
            base = np.cumsum(n + 1) - (n + 1)
            left = np.full((LONGEST, int((n + 1).sum())), -1, dtype=np.int32)
            left[ln - 1, base[w] + end] = piece
        mask = np.where(start == 0, (1 << LONGEST) - 1, 0)
        inner = np.flatnonzero(start > 0)
        at = (base[w] + start)[inner]
        asked = []
        for k in range(LONGEST):
            p = left[k, at] if len(inner) else np.zeros(0, np.int32)
            hit = p >= 0
            free = hit & ((p >= UNKNOWN) | (piece[inner] >= UNKNOWN))
            mask[inner[free]] |= 1 << k
            ask = np.flatnonzero(hit & ~free)
            asked.append((np.full(len(ask), k), inner[ask], p[ask]))
        k, e, p = (np.concatenate(x) for x in zip(*asked))
        if len(k):
            ok = self.pairs(p, piece[e])
            np.bitwise_or.at(mask, e[ok], 1 << k[ok])
        # an edge without a bit is on no path
        some = np.flatnonzero(mask)
        out = ((piece << 1 | end & 1) << 4 | ln - 1) << 16 | mask
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(some, off), pa.int32()), pa.array(out[some], pa.int64()))

    def spelled(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in which characters without a piece are their bytes, and the counts."""
        unknown = ids >= UNKNOWN
        if not unknown.any():
            return ids, count
        c = np.where(unknown, ids - UNKNOWN, 0)
        width = np.where(unknown, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
        rep = np.repeat(np.arange(len(ids)), width)
        k = np.arange(len(rep)) - np.repeat(np.cumsum(width) - width, width)
        c, w = c[rep], width[rep]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[w] | c >> 6 * (w - 1)
        byte = np.where(w == 1, c & 0x7F, np.where(k == 0, lead, 0x80 | c >> 6 * (w - 1 - k) & 0x3F))
        owner = np.repeat(np.arange(len(count)), count)
        return (np.where(unknown[rep], self.byte_id[byte & 0xFF], ids[rep]),
                np.bincount(owner[rep], minlength=len(count)).astype(np.int64))

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and counts -> UTF-8 bytes and the size of each text."""
        size = self.raw_size[ids]
        out = self.raw[np.repeat(self.raw_at[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        at = np.concatenate([[0], np.cumsum(size)])
        edge = at[np.concatenate([[0], np.cumsum(count)])]
        some = np.flatnonzero(count > 0)
        # the blank put before the text
        out = np.delete(out, edge[some])
        total = np.diff(edge)
        total[some] -= 1
        return out, total


class Places:
    """Places of keys, which are hashes themselves, in an open hash table."""

    def __init__(self, key: np.ndarray):
        self.n, self.key, self.place = 0, np.zeros(1, np.int64), np.full(1, -1, np.int32)
        self.add(key)

    def add(self, key: np.ndarray) -> None:
        """The next places for new keys; of equal ones any place counts."""
        if 2 * (self.n + len(key)) >= len(self.key):
            used = self.place >= 0
            old, place = self.key[used], self.place[used]
            size = 1 << int(4 * (self.n + len(key)) + 1).bit_length()
            self.key, self.place = np.zeros(size, np.int64), np.full(size, -1, np.int32)
            self._put(old, place)
        self._put(key, np.arange(self.n, self.n + len(key), dtype=np.int32))
        self.n += len(key)

    def _put(self, key: np.ndarray, place: np.ndarray) -> None:
        mask = len(self.key) - 1
        slot = key & mask
        while len(key):
            free = self.place[slot] < 0
            self.key[slot[free]], self.place[slot[free]] = key[free], place[free]
            on = self.key[slot] != key
            key, place, slot = key[on], place[on], slot[on] + 1 & mask

    def find(self, key: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        mask = len(self.key) - 1
        slot = key & mask
        at = self.place[slot]
        on = np.flatnonzero((at >= 0) & (self.key[slot] != key))
        slot = slot[on]
        while len(on):
            slot = slot + 1 & mask
            at[on] = self.place[slot]
            more = (at[on] >= 0) & (self.key[slot] != key[on])
            on, slot = on[more], slot[more]
        return at


class Lexicon:
    """Ids of segments by the first half of their keys."""

    def __init__(self, pieces: Pieces, key: np.ndarray, ids: np.ndarray, count: np.ndarray):
        ids, count = pieces.spelled(ids, count)
        self.n, self.at, self.ids = count, np.cumsum(count) - count, ids.astype(np.int32)
        self.find = Places(key).find


_PIECES: dict[str, Pieces] = {}
_HOT: dict[str, Lexicon] = {}


def _pieces(model: str, table) -> Pieces:
    """The worker's tables of a model, with the pairs that it knows."""
    if model not in _PIECES:
        _PIECES.clear()
        _PIECES[model] = Pieces(table)
    return _PIECES[model]


def _hot(pieces: Pieces, name: str, hot) -> Lexicon:
    if name not in _HOT:
        _HOT.clear()
        _HOT[name] = Lexicon(pieces, *hot)
    return _HOT[name]


def _segments(batches, model, table) -> Iterator[pa.RecordBatch]:
    """Distinct segments of some slices at a time and how often they occur."""
    t = _pieces(model, table)

    def batch(parts, n):
        h1, h2, width, text = (np.concatenate(x) for x in zip(*parts))
        flat = np.frombuffer(text.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
        chars = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))
        o = chars[np.append(np.cumsum(width) - width, len(text))]
        return pa.RecordBatch.from_arrays(
            [pa.array(h1), pa.array(h2), pa.LargeStringArray.from_buffers(
                len(h1), pa.py_buffer(o.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string()), pa.array(n)],
            ["h1", "h2", "segment", "n"])

    known, parts, n = Places(np.zeros(0, np.int64)), [], np.zeros(0, np.int64)
    for b in batches:
        for _, _, data, off in scan.slices(b.column(0)):
            cp, first, width, h1, _ = t.segments(data, off)
            if not len(first):
                continue
            at = known.find(h1)
            new = np.flatnonzero(at < 0)
            key, pick, count = np.unique(h1[new], return_index=True, return_counts=True)
            n = np.concatenate([n + np.bincount(at[at >= 0], minlength=len(n)), count])
            known.add(key)
            h2, text = t.second(cp, first[new[pick]], width[new[pick]])
            parts.append((key, h2, width[new[pick]], text))
            if sum(len(x[3]) for x in parts) >= HELD:
                yield batch(parts, n)
                known, parts, n = Places(np.zeros(0, np.int64)), [], np.zeros(0, np.int64)
    if parts:
        yield batch(parts, n)


def _with_masks(batches, model, table) -> Iterator[pa.RecordBatch]:
    t = _pieces(model, table)
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:3], t.masks(b.column(3))], ["h1", "h2", "n", "edges"])


def _in_blocks(items: Column, first: dict[str, Column], step) -> Column:
    """What a fold appends to ``out``, in reverse.  Short inner folds fill ``out``, which an
    outer one appends to the whole, so that long segments stay cheap.  ``step`` gives a
    state's new fields."""
    none = F.array().cast("array<bigint>")
    pack = lambda state, whole, out: F.struct(*(state[k].alias(k) for k in first), whole.alias("whole"), out.alias("out"))
    return F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), pack(first, none, none),
        lambda acc, c: F.aggregate(
            F.slice(items, c * BLOCK + 1, BLOCK), acc, lambda s, e: step(s, e, lambda new, x: pack(
                new, s["whole"], F.concat(s["out"], F.array(x)))),
            lambda s: pack(s, F.concat(s["whole"], s["out"]), none)),
        lambda s: F.reverse(s["whole"]))


def lattice(segments: DataFrame, model: str = MODEL) -> DataFrame:
    """(h1, h2, n, ids) of distinct segments (h1, h2, segment, n); an id from ``UNKNOWN``
    on is a character without a piece."""
    spark = segments.sparkSession
    ship(spark)
    table = piece_table(model)
    shared = spark.sparkContext.broadcast(table)
    known = Pairs(table).id
    # the size of the vocabulary
    pieces = F.broadcast(spark.createDataFrame([(p, i) for p, i in known.items()], "piece string, id long"))
    longest = max(map(len, known))
    size = F.length("segment")
    window = segments.select("h1", "h2", "n", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / WINDOW).cast("int")),
        lambda c: F.substring("segment", c * WINDOW + 1, F.lit(WINDOW + longest - 1)))).alias("c", "window"))
    at = window.select("h1", "h2", "n", "c", "window", F.explode(
        F.sequence(F.lit(0), F.least(F.lit(WINDOW), F.length("window")) - 1)).alias("at"))
    # windows overlap by the longest piece; the next one begins where this one's starts end
    strings = at.select("h1", "h2", "n", "c", "window", "at", F.explode(
        F.sequence(F.lit(1), F.least(F.lit(longest), F.length("window") - F.col("at")))).alias("k")).select(
        "h1", "h2", "n", (F.col("c") * F.lit(WINDOW).cast("long") + F.col("at")).alias("start"),
        F.substring(F.col("window"), F.col("at") + 1, F.col("k")).alias("piece"))
    ln = F.length("piece")
    edge = strings.join(pieces, "piece", "left").filter((F.col("id").isNotNull()) | (ln == 1)).select(
        "h1", "h2", "n", F.shiftleft("start", 26).bitwiseOR(F.shiftleft((ln - 1).cast("long"), ID_BITS)).bitwiseOR(
            F.coalesce("id", F.lit(UNKNOWN) + F.ascii("piece"))).alias("edge"))
    grouped = edge.groupBy("h1", "h2", "n").agg(F.collect_list("edge").alias("edges"))
    ready = grouped.mapInArrow(lambda it: _with_masks(it, model, shared.value), "h1 long, h2 long, n long, edges array<long>")

    # ring: lengths - 1 of the surviving edges that end at the last 16 positions, four bits each;
    # odd: whether the last of these positions is odd
    zero = F.lit(0).cast("long")

    def survive(s, e, put):
        size = F.shiftright(e, 16).bitwiseAND(F.lit(15))
        before = F.call_function("shiftright", s["ring"], (size * 4).cast("int")).bitwiseAND(F.lit(15)).cast("int")
        stable = F.call_function("shiftright", e, before).bitwiseAND(F.lit(1)) == 1
        ahead = F.shiftright(e, 20).bitwiseAND(F.lit(1)) != s["odd"]
        return F.when(ahead & stable, put({"ring": F.shiftleft(s["ring"], 4).bitwiseOR(size), "odd": 1 - s["odd"]}, e)).otherwise(s)

    def walk_back(s, e, put):
        passed = F.struct((s["skip"] - 1).alias("skip"), s["whole"].alias("whole"), s["out"].alias("out"))
        return F.when(s["skip"] > 0, passed).otherwise(
            put({"skip": F.shiftright(e, 16).bitwiseAND(F.lit(15))}, F.shiftright(e, 21)))

    last = ready.select("h1", "h2", "n", _in_blocks(F.col("edges"), {"ring": zero, "odd": zero}, survive).alias("last"))
    return last.select("h1", "h2", "n", _in_blocks(F.col("last"), {"skip": zero}, walk_back).cast("array<int>").alias("ids"))


def _most_frequent(lexicon: DataFrame, hot: int) -> DataFrame:
    """The segments from the lowest count on at which no more than ``hot`` are left."""
    short = lexicon.filter(F.size("ids") <= HOT_IDS)
    step = F.floor(8 * F.log2("n")).cast("int")
    room, least = hot, NEVER
    for r in sorted(short.groupBy(step.alias("b")).count().collect(), key=lambda r: -r.b):   # some 500 rows
        if r["count"] > room:
            break
        room, least = room - r["count"], r.b
    return short.filter(step >= least)


def _rare(batches, model, table, name, hot) -> Iterator[pa.RecordBatch]:
    """The distinct segments of each text that are not broadcast."""
    t = _pieces(model, table)
    known = _hot(t, name, hot)
    for b in batches:
        t1, t2 = (np.asarray(b.column(i), dtype=np.int64) for i in (1, 2))
        for lo, _, data, off in scan.slices(b.column(0)):
            cp, first, width, h1, edge = t.segments(data, off)
            on = np.flatnonzero(known.find(h1) < 0)
            doc = np.searchsorted(edge, on, "right") - 1
            order = np.lexsort((h1[on], doc))
            on, doc = on[order], doc[order]
            if len(on):
                new = np.append(True, (doc[1:] != doc[:-1]) | (h1[on[1:]] != h1[on[:-1]]))
                on, doc = on[new], doc[new]
            h2, _ = t.second(cp, first[on], width[on])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (t1[lo + doc], t2[lo + doc], h1[on], h2)],
                                             ["t1", "t2", "h1", "h2"])


def _flat(col) -> tuple[np.ndarray, np.ndarray]:
    """Values and counts of a list column without nulls."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    off = np.asarray(col.offsets, dtype=np.int64)
    return np.asarray(col.values.slice(int(off[0]), int(off[-1] - off[0])), dtype=np.int64), np.diff(off)


#: a text's segments that are not broadcast: keys, numbers of pieces, pieces
RARE = {"rare_key": "bigint", "rare_n": "int", "rare_ids": "int"}


def _encode(batches, model, table, name, hot) -> Iterator[pa.RecordBatch]:
    t = _pieces(model, table)
    known = _hot(t, name, hot)
    for b in batches:
        text, *rare = (b.column(b.schema.get_field_index(c)) for c in ("text", *RARE))
        for lo, hi, data, off in scan.slices(text):
            _, _, _, h1, edge = t.segments(data, off)
            key, size, part = (np.asarray(c.slice(lo, hi - lo).flatten(), dtype=np.int64) for c in rare)
            at = known.find(h1)
            n, first, words = known.n, known.at, known.ids
            other = np.flatnonzero(at < 0)
            if len(key):
                own = Lexicon(t, key, part, size)
                found = own.find(h1[other])
                at[other] = np.where(found >= 0, found + len(n), -1)
                n = np.concatenate([n, own.n])
                first = np.concatenate([first, own.at + len(words)])
                words = np.concatenate([words, own.ids])
            if len(other) and at[other].min() < 0:
                raise RuntimeError("a segment is in no lexicon: the texts changed between two reads")
            each = n[at] if len(at) else np.zeros(0, np.int64)
            upto = np.concatenate([[0], np.cumsum(each)])
            ids = words[np.repeat((first[at] if len(at) else each) - upto[:-1], each) + np.arange(int(upto[-1]))]
            count = np.diff(upto[edge])
            back, size = t.decode(ids, count)
            null = np.array(text.slice(lo, hi - lo).is_null())
            o = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("row")).slice(lo, hi - lo),
                 pa.ListArray.from_arrays(pa.array(o, mask=np.append(null, False)), pa.array(ids, pa.int32())),
                 pa.array(count, pa.int64(), mask=null), pa.array(_equal_texts(data, off, back, size), mask=null)],
                ["row", "ids", "n_pieces", "round_trip"])


def _equal_texts(data, off, back, size) -> np.ndarray:
    """Which texts decode to themselves."""
    same = np.diff(off) == size
    at = np.concatenate([[0], np.cumsum(size)])
    if same.all():
        wrong = np.concatenate([[0], np.cumsum(data != back)])
        return wrong[off[1:]] == wrong[off[:-1]]
    return np.array([bool(s) and np.array_equal(data[off[i]:off[i + 1]], back[at[i]:at[i + 1]])
                     for i, s in enumerate(same)])


def _decode(batches, model, table) -> Iterator[pa.RecordBatch]:
    t = _pieces(model, table)
    for b in batches:
        texts = []
        for ids in b.column(b.schema.get_field_index("ids")).to_pylist():
            if ids is None:
                texts.append(None)
                continue
            out, _ = t.decode(np.array(ids, dtype=np.int64), np.array([len(ids)]))
            texts.append(out.tobytes().decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("row")), pa.array(texts, pa.string())], ["row", "text"])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _row(df: DataFrame, read: str, made: list[str]) -> Column:
    """The other columns as one, of any names, behind a flag that keeps it from being empty."""
    taken = {c.lower() for c in [read, *made]}
    flag = "_" * (1 + max(map(len, df.columns)))
    return F.struct(F.lit(0).alias(flag), *(F.col(_quoted(c)) for c in df.columns if c.lower() not in taken)).alias("row")


def _unpacked(out: DataFrame, made: list[str]) -> DataFrame:
    return out.select(*(F.col(f"row.{_quoted(f.name)}") for f in out.schema["row"].dataType.fields[1:]), *made)


def encode(docs: DataFrame, model: str = MODEL, hot: int = HOT, copies: int = COPIES) -> DataFrame:
    """Replace ``text`` by ``ids``, ``n_pieces`` and ``round_trip``."""
    spark = docs.sparkSession
    ship(spark)
    table = piece_table(model)
    shared = spark.sparkContext.broadcast(table)   # the size of the vocabulary
    text = docs.select("text")
    # dealt by the key once, for counting and for the lattice
    lexicon = materialise(lattice(text.mapInArrow(
        lambda it: _segments(it, model, shared.value), "h1 long, h2 long, segment string, n long")
        .repartition("h1", "h2").groupBy("h1", "h2", "segment").agg(F.sum("n").alias("n")), model), "sp-lexicon", codec="zstd")
    free_shuffles(spark)
    top = _most_frequent(lexicon, hot).select("h1", "ids").toArrow()   # at most ``hot`` rows of HOT_IDS ids
    name = uuid.uuid4().hex
    frequent = spark.sparkContext.broadcast((top["h1"].to_numpy(), *_flat(top["ids"])))
    keyed = docs.select(_row(docs, "text", ["ids", "n_pieces", "round_trip"]), "text",
                        F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    rare = keyed.select("text", "t1", "t2").mapInArrow(
        lambda it: _rare(it, model, shared.value, name, frequent.value), "t1 long, t2 long, h1 long, h2 long")
    # written before the texts are moved, so that all shuffle files up to here can go
    lists = materialise(rare.join(lexicon.select("h1", "h2", "ids"), ["h1", "h2"]).groupBy("t1", "t2").agg(
        F.collect_set(F.struct("h1", "ids")).alias("rare")), "sp-lists", codec="zstd")
    del rare
    drop_table(spark, lexicon)
    free_shuffles(spark)
    # texts of many copies are dealt over SALTS tasks; beyond the first COPIED none holds 0.1 % of the rows
    copied = F.broadcast(keyed.groupBy("t1", "t2").count().orderBy(F.desc("count"), "t1", "t2").limit(COPIED)
                         .filter(F.col("count") > copies).select("t1", "t2", F.lit(SALTS).alias("salts")))
    salted = keyed.join(copied, ["t1", "t2"], "left").withColumn(
        "salt", F.coalesce(F.monotonically_increasing_id() % F.col("salts"), F.lit(0).cast("long")))
    # three flat lists take half the room of one of pairs
    flat = lists.select("t1", "t2", F.col("rare.h1").alias("rare_key"), F.transform("rare.ids", F.size).alias("rare_n"),
                        F.flatten("rare.ids").alias("rare_ids"))
    dealt = flat.join(copied, ["t1", "t2"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1)))
    rows = salted.join(dealt, ["t1", "t2", "salt"], "left").select("row", "text", *(
        F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c) for c, kind in RARE.items()))
    out = rows.mapInArrow(lambda it: _encode(it, model, shared.value, name, frequent.value),
                          StructType([rows.schema["row"]]).add("ids", ArrayType(IntegerType())).add("n_pieces", "long")
                          .add("round_trip", "boolean"))
    return _unpacked(out, ["ids", "n_pieces", "round_trip"])


def decode(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """Replace ``ids`` by ``text``."""
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(piece_table(model))
    keyed = rows.select(_row(rows, "ids", ["text"]), "ids")
    return _unpacked(keyed.mapInArrow(
        lambda it: _decode(it, model, shared.value), StructType([keyed.schema["row"]]).add("text", "string")), ["text"])
