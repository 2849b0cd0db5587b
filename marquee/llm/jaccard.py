"""Exact n-gram Jaccard join by signature trees (operator 1).

A document is the set of its distinct ``k``-word shingles; two documents
link when ``100 * |A & B| >= pct * |A | B|`` and both sets are non-empty.
The result is one row per document with its connected component.

1. Equal sets collapse to one *node* (128-bit digest of the sorted hashes).
2. A linked pair shares one of its ``prefix(n)`` smallest shingles under any
   common order.  Shingles that only one node has (looked for among the
   smallest hashes, ``private_range``, over all documents) are put first in
   that order: a node with at least ``prefix(n)`` such private shingles has
   no link and is finished.  This removes what is not a near copy, documents
   with only some shared passages included, without looking at any pair.
3. Among the others the order is refined, rarer shingles first, so that a
   passage many documents share is in few prefixes.  Nodes are joined to
   clusters through their prefix shingles (:mod:`components`); links never
   cross clusters.
4. A cluster of up to ``max_unit`` nodes is one unit.  Larger clusters are
   cut twice into random units, which finds most links.  The pairs that are
   then still apart meet in blocks of the cluster's nodes of like size, where
   a size is crowded in blocks of those with a common prefix shingle; a block that holds more than ``max_unit`` nodes is dealt into chunks
   by component, and every pair of chunks that does not lie in one component
   is a unit.  No pair is lost and no unit is larger than about twice
   ``max_unit``.
5. Each unit builds a signature tree: leaves hold a node's token bitmap and
   size, inner nodes the OR of their children's bitmaps and the range of
   sizes.  The dual traversal drops pairs of tree nodes whose largest
   possible overlap is too small, and the leaf pairs that remain are
   compared by their sorted shingles unless already connected.

Null or empty texts, and texts without words, have no shingles and link to
nothing.  Repeated rows give one result row each; a null doc_id never
becomes a component's name unless the whole component has none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import scan
from marquee.llm.common import iter_groups, materialise, ship
from marquee.llm.components import connected_components

FANOUT = 8
FILTER_WORDS = 1 << 18


def private_range(pct: int) -> float:
    """Share of the hash range in which shingles of a single node are looked
    for: about five thirds of the prefix, so that most nodes show enough."""
    return min(0.99, (100 - pct) / 60)


SIGN = np.uint64(1 << 63)


def prefix(pct: int):
    """Shingles of a set of ``n`` of which a linked set must share one:
    all but ``ceil(n * pct / 100)``, and one more."""
    return F.expr(f"n * {100 - pct} div 100 + 1")


def _signed(h: np.ndarray) -> np.ndarray:
    """Order-preserving map of unsigned to signed 64-bit."""
    return (h ^ SIGN).view(np.int64)


def _doc_sets(batches, k, pct, out: str) -> Iterator[pa.RecordBatch]:
    """Per document: its node digest with its size, low or all shingles."""
    top = np.uint64(int(private_range(pct) * 2.0 ** 64))
    for b in batches:
        others = [(f.name, b.column(i)) for i, f in enumerate(b.schema) if f.name != "text"]
        for lo, hi, data, off in scan.slices(b.column(b.schema.get_field_index("text"))):
            w = scan.words(scan.LOWER[data], off)
            doc, h = scan.shingles(w, k)
            m = hi - lo
            n = np.bincount(doc, minlength=m)
            at = np.concatenate([[0], np.cumsum(n)])
            raw = h.tobytes()
            node = [hashlib.blake2b(raw[8 * at[i]:8 * at[i + 1]], digest_size=16).digest() if n[i] else None
                    for i in range(m)]
            cols = [(c, v.slice(lo, m)) for c, v in others] + [("n", pa.array(n, pa.int64())),
                                                                ("node", pa.array(node, pa.binary()))]
            if out == "low":
                keep = h < top
                cols.append(("toks", scan.lists(_signed(h[keep]), np.bincount(doc[keep], minlength=m), pa.int64())))
            elif out == "all":
                cols.append(("toks", scan.lists(_signed(h), n, pa.int64())))
            yield pa.RecordBatch.from_arrays([v for _, v in cols], [c for c, _ in cols])


def _sets(docs: DataFrame, k: int, pct: int, out: str) -> DataFrame:
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join([*(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept), "n long", "node binary",
                        *(["toks array<long>"] if out != "meta" else [])])
    return docs.mapInArrow(lambda it: _doc_sets(it, k, pct, out), schema)


def _may_hold(rows: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` may be among the ``col`` of ``keys``, by a bitmap.

    The bitmap is broadcast: at most ``FILTER_WORDS`` rows of two longs (4 MB),
    however many keys there are.  It only spares the shuffle of rows that the
    exact join after it would drop; with many more keys than bits it passes all.
    """
    slot = f"pmod(xxhash64({col}, 17), {64 * FILTER_WORDS})"
    words = keys.selectExpr(f"{slot} div 64 AS word", f"shiftleft(1L, cast({slot} % 64 AS int)) AS bit").groupBy(
        "word").agg(F.bit_or("bit").alias("bits"))
    return (rows.withColumn("word", F.expr(f"{slot} div 64")).join(F.broadcast(words), "word")
            .filter(f"getbit(bits, cast({slot} % 64 AS int)) = 1").drop("word", "bits"))


# ------------------------------------------------------------- signature tree
class Tree:
    """Levels of a signature tree, leaves first; sets are sorted arrays."""

    def __init__(self, toks: list[np.ndarray], bits: int):
        size = np.array([len(t) for t in toks], dtype=np.int64)
        owner = np.repeat(np.arange(len(toks)), size)
        place = (np.concatenate(toks).view(np.uint64) % np.uint64(bits)).astype(np.int64)
        flags = np.zeros((len(toks), bits), dtype=bool)
        flags[owner, place] = True
        sig = np.packbits(flags, axis=1).view(np.uint64)
        # what a set can share beyond its number of set bits
        excess = size - flags.sum(1)
        self.levels = [(sig, size, size, excess)]
        while len(self.levels[-1][1]) > FANOUT:
            sig, low, high, exc = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(sig, cut, axis=0), np.minimum.reduceat(low, cut),
                                np.maximum.reduceat(high, cut), np.maximum.reduceat(exc, cut)))


def _may_link(a, b, i, j, pct: int) -> np.ndarray:
    """Which pairs (i, j) of two levels can hold a link, by sizes and bitmaps."""
    out = np.zeros(len(i), dtype=bool)
    step = max(1, (1 << 20) // a[0].shape[1])
    for lo in range(0, len(i), step):
        x, y = i[lo:lo + step], j[lo:lo + step]
        shared = np.bitwise_count(a[0][x] & b[0][y]).sum(1, dtype=np.int64) + np.minimum(a[3][x], b[3][y])
        shared = np.minimum(shared, np.minimum(a[2][x], b[2][y]))
        need = (pct * (a[1][x] + b[1][y]) + pct + 99) // (100 + pct)
        sizes = (100 * a[2][x] >= pct * b[1][y]) & (100 * b[2][y] >= pct * a[1][x])
        out[lo:lo + step] = sizes & (shared >= need)
    return out


def _pairs(left: Tree, right: Tree, same: bool, pct: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs that survive the dual traversal, in blocks of bounded size."""
    top = max(len(left.levels), len(right.levels)) - 1
    at = lambda t, lv: t.levels[min(lv, len(t.levels) - 1)]
    a, b = at(left, top), at(right, top)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a[1])), np.arange(len(b[1])), indexing="ij"))
    stack = [(top, i, j)]
    while stack:
        lv, i, j = stack.pop()
        if same:
            keep = i <= j
            i, j = i[keep], j[keep]
        keep = _may_link(at(left, lv), at(right, lv), i, j, pct)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if lv == 0:
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            yield i, j
            continue
        for lo in range(0, len(i), 4096):
            x, y = i[lo:lo + 4096], j[lo:lo + 4096]
            for t, side in ((left, 0), (right, 1)):
                if lv < len(t.levels):
                    kids = (np.repeat((x, y)[side], FANOUT) * FANOUT
                            + np.tile(np.arange(FANOUT), len(x)))
                    other = np.repeat((y, x)[side], FANOUT)
                    ok = kids < len(t.levels[lv - 1][1])
                    x, y = (kids[ok], other[ok]) if side == 0 else (other[ok], kids[ok])
            stack.append((lv - 1, x, y))


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def linked(toks: list[np.ndarray], pct: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; with ``side`` (0/1) at
    least all links between the two sides are taken into account."""
    label = np.arange(len(toks))
    most = max(len(t) for t in toks)
    bits = 64
    while bits < min(2 * most, 1 << 15):
        bits *= 2
    low = np.array([t[0] for t in toks])
    order = np.lexsort((np.array([len(t) for t in toks]), low))
    if side is None:
        groups = [(order, order)]
    else:
        groups = [(order[side[order] == 0], order[side[order] == 1])]
    found = []
    for ga, gb in groups:
        if not len(ga) or not len(gb):
            continue
        ta = Tree([toks[x] for x in ga], bits)
        tb = ta if side is None else Tree([toks[x] for x in gb], bits)
        for i, j in _pairs(ta, tb, side is None, pct):
            a, b = ga[i], gb[j]
            while len(a):
                apart = label[a] != label[b]
                a, b = a[apart], b[apart]
                for x, y in zip(a[:256].tolist(), b[:256].tolist()):
                    if label[x] != label[y]:
                        s = _overlap(toks[x], toks[y])
                        if 100 * s >= pct * (len(toks[x]) + len(toks[y]) - s):
                            found.append((x, y))
                            label[label == label[y]] = label[x]
                a, b = a[256:], b[256:]
    return found


def _unit_links(batches, pct: int) -> Iterator[pa.RecordBatch]:
    for t in iter_groups(batches, "unit"):
        t = t.combine_chunks()
        col = t.column("toks").chunk(0)
        off = col.offsets.to_numpy()
        flat = col.values.to_numpy()
        toks = [flat[off[i]:off[i + 1]] for i in range(t.num_rows)]
        if t.num_rows < 2:
            continue
        side = t.column("side").to_numpy()
        pairs = linked(toks, pct, None if side.max() == 0 else side)
        if pairs:
            node = t.column("node").chunk(0)
            yield pa.RecordBatch.from_arrays(
                [node.take(pa.array([p[0] for p in pairs])), node.take(pa.array([p[1] for p in pairs]))], ["u", "v"])


def _links(units: DataFrame, pct: int) -> DataFrame:
    """units (unit, side, node, toks) -> links (u, v)."""
    return (units.select("unit", "side", "node", "toks").repartition("unit").sortWithinPartitions("unit")
            .mapInArrow(lambda it: _unit_links(it, pct), "u binary, v binary"))


def _blocks(big: DataFrame, pre: DataFrame, sets: DataFrame, pct: int, most: int) -> DataFrame:
    """(block, node): nodes of a cluster by size, those of a crowded size by
    prefix shingle as well.

    A band of sizes is as wide as linked sets can differ, so two linked sets
    lie in the same or in adjacent bands and meet in the upper one.
    """
    width = 1.0001 * math.log(100 / pct)
    band = F.floor(F.log(F.col("n").cast("double")) / width)
    rows = big.join(sets.select("node", band.alias("band")), "node").select(
        "node", "cluster", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    sized = rows.join(rows.groupBy("cluster", "band").agg(F.count("*").alias("c")), ["cluster", "band"])
    few = sized.filter(F.col("c") <= most).select(F.xxhash64("cluster", "band").alias("block"), "node")
    many = sized.filter(F.col("c") > most).join(pre, "node").select(
        F.xxhash64("cluster", "band", "tok").alias("block"), "node")
    return few.unionByName(many)


def _grid(blocks: DataFrame, found: DataFrame, max_unit: int) -> DataFrame:
    """Units for the pairs of a block that are not in one component yet; a
    large block is cut into chunks and every pair of chunks is a unit."""
    comp = connected_components(found)
    lab = blocks.join(comp, "node", "left").select(
        F.col("block").alias("cluster"), "node", F.coalesce("root", "node").alias("root"))
    mixed = lab.groupBy("cluster").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b")
    lab = materialise(lab.join(mixed.select("cluster"), "cluster"), "jaccard-blocks")
    per = lab.groupBy("cluster", "root").agg(F.count("*").alias("c"))
    per = per.withColumn("whole", F.col("c") >= max_unit // 2)
    rest = per.filter(~F.col("whole")).groupBy("cluster").agg(F.sum("c").alias("rest"))
    parts = (per.join(rest, "cluster", "left")
             .withColumn("parts", F.ceil(F.when(F.col("whole"), F.col("c")).otherwise(F.col("rest")) / max_unit)))
    dealt = lab.join(parts, ["cluster", "root"]).select(
        "cluster", "node",
        F.when(F.col("whole"), F.col("root")).alias("label"),
        F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).alias("part"))
    dealt = materialise(dealt.withColumn(
        "chunk", F.xxhash64("cluster", F.coalesce(F.hex("label"), F.lit("")), "part")), "jaccard-chunks")
    chunks = dealt.select("cluster", "chunk", "label").distinct()
    other = chunks.select("cluster", F.col("chunk").alias("chunk2"), F.col("label").alias("label2"))
    pairs = (chunks.join(other, "cluster")
             .filter("chunk < chunk2 or (chunk = chunk2 and label is null)")
             .filter("label is null or label2 is null or label != label2")
             .withColumn("unit", F.xxhash64("chunk", "chunk2")))
    sides = pairs.select("unit", F.explode(F.when(
        F.col("chunk") == F.col("chunk2"), F.array(F.struct(F.col("chunk"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("chunk"), F.lit(0).alias("side")),
                F.struct(F.col("chunk2").alias("chunk"), F.lit(1).alias("side"))))).alias("s"))
    return sides.select("unit", "s.*").join(dealt.select("chunk", "node"), "chunk").select("unit", "side", "node")


def ngram_jaccard_components(docs: DataFrame, k: int = 4, pct: int = 85, max_unit: int = 1024,
                             passed: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, n_shingles, component_id), a row per row.

    ``component_id`` is the smallest doc_id reachable by links (its own if
    there is none).  With ``passed``, those columns follow as they are, and
    ``group``, which is the same for the rows of one component whatever their
    ids are (null for a row without shingles).
    """
    spark = docs.sparkSession
    ship(spark)
    # a long that names the row's text: the document id, or a hash where it is null
    base = docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("key"), "text", *passed)
    meta = materialise(_sets(base, k, pct, "meta"), "jaccard-meta")
    # the row that stands for a node: its smallest key, with the rows that share it
    nodes = (meta.filter("n > 0").groupBy("node", "key")
             .agg(F.first("n").alias("n"), F.min("doc_id").alias("low_id"), F.count("*").alias("copies"))
             .groupBy("node").agg(F.first("n").alias("n"), F.min("low_id").alias("low_id"),
                                  F.min(F.struct("key", "copies")).alias("row"))
             .select("node", "n", "low_id", "row.*"))

    # private shingles: seen with one node only (equal sets count once)
    low = (_sets(base.select("text"), k, pct, "low").filter("size(toks) > 0")
           .select(F.explode("toks").alias("tok"), F.xxhash64("node").alias("h")))
    private = (low.groupBy("tok").agg(F.min("h").alias("h"), F.max("h").alias("h2")).filter("h = h2")
               .groupBy("h").agg(F.count("*").alias("own")))
    open_nodes = materialise(
        nodes.withColumn("h", F.xxhash64("node")).join(private, "h", "left")
        .filter(F.coalesce("own", F.lit(0)) < prefix(pct))
        .select("node", "key", "copies"), "jaccard-open")

    texts = _may_hold(base, open_nodes, "key").join(open_nodes.withColumnRenamed("node", "want"), "key")
    sets = materialise(
        _sets(texts.select("want", "copies", "text"), k, pct, "all").filter("node = want").drop("want"), "jaccard-sets")
    # only rows that repeat both doc_id and words need the shuffle
    sets = (sets.filter("copies = 1").unionByName(sets.filter("copies > 1").dropDuplicates(["node"]))
            .drop("copies"))

    # prefix shingles in one order for all sets: those in the low range first,
    # the rarer (among the open nodes) before the more common, then by hash
    low_end = int(private_range(pct) * 2.0 ** 64) - (1 << 63)
    low_rows = sets.select("node", F.explode(F.filter("toks", lambda t: t < low_end)).alias("tok"))
    common = low_rows.groupBy("tok").agg(F.count("*").alias("c")).filter("c > 1")
    ranked = low_rows.join(common, "tok").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("c", "tok"))).alias("shared"))
    n_low = F.size(F.filter("toks", lambda t: t < low_end))
    room = (prefix(pct) - (n_low - F.coalesce(F.size("shared"), F.lit(0)))).cast("int")
    more = (prefix(pct) - n_low).cast("int")
    chosen = sets.join(ranked, "node", "left").select("node", F.concat(
        F.when((room > 0) & F.col("shared").isNotNull(), F.transform(
            F.slice("shared", F.lit(1), F.greatest(room, F.lit(0))), lambda x: x["tok"])).otherwise(F.array().cast("array<long>")),
        F.when(more > 0, F.slice(F.filter("toks", lambda t: t >= low_end), F.lit(1), F.greatest(more, F.lit(0))))
        .otherwise(F.array().cast("array<long>"))).alias("pre"))
    # clusters by shared prefix shingles
    pre = materialise(chosen.select("node", F.explode("pre").alias("tok")), "jaccard-prefix")
    hubs = pre.groupBy("tok").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    clusters = connected_components(
        pre.join(hubs, "tok").select(F.col("node").alias("u"), F.col("hub").alias("v")))
    clusters = materialise(clusters.withColumnRenamed("root", "cluster"), "jaccard-clusters")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("c"))
    dealt = clusters.join(sizes, "cluster").withColumn("parts", F.ceil(F.col("c") / max_unit))

    def random_units(rows: DataFrame, salt: int) -> DataFrame:
        part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node", F.lit(salt)), F.col("parts"))).otherwise(F.lit(0))
        return rows.select("node", F.xxhash64("cluster", part, F.lit(salt)).alias("unit"), F.lit(0).alias("side"))

    first = random_units(dealt, 1).unionByName(random_units(dealt.filter("parts > 1"), 2))
    found = materialise(_links(first.join(sets, "node"), pct), "jaccard-links")
    blocks = _blocks(dealt.filter("parts > 1").select("node", "cluster"), pre, sets, pct, 4 * max_unit)
    more = _links(_grid(blocks, found, max_unit).join(sets, "node"), pct)
    comp = connected_components(found.unionByName(more))

    named = comp.join(nodes.select("node", "low_id"), "node")
    names = named.groupBy("root").agg(F.min("low_id").alias("name"))
    by_node = nodes.join(comp, "node", "left").join(names, "root", "left").select(
        "node", F.coalesce("name", "low_id").alias("component_id"), F.coalesce("root", "node").alias("group"))
    return meta.join(by_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), *passed, *(["group"] if passed else []))
