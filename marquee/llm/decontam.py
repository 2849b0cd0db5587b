"""Benchmark decontamination by pigeonhole edit matching (operator 7).

An item occurs in a document when some substring of the document is within
``errors(n)`` edits (insert, delete, replace) of the item's ``n`` characters,
both in lower case with white space collapsed.  If an item is cut into
errors + 1 pieces, an occurrence keeps one of them intact, so exact piece
hits (one Aho-Corasick pass over the text) find every candidate place; each
place is verified with Myers' bit-parallel distance.

The benchmark is the query set: it is read in blocks of at most about
``block_chars`` characters, each broadcast to a scan of all documents, so
what is broadcast never grows with either table.

Null and blank items match nothing, null and empty texts contain nothing.
An item too short for two pieces of ``min_piece`` characters must occur
exactly.  Repeated rows give repeated results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def errors(n: int, rate: float, min_piece: int) -> int:
    """Edits allowed in an item of ``n`` characters."""
    return max(0, min(int(rate * n), n // min_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` adjacent pieces of almost equal length, with their offsets."""
    n = len(item)
    cut = [n * j // (k + 1) for j in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:])]


class Pattern:
    """An item prepared for Myers' search."""

    def __init__(self, item: str):
        self.size = len(item)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | (1 << i)

    def best(self, text: str) -> int:
        """Smallest edit distance between the item and a substring of ``text``."""
        ones = (1 << self.size) - 1
        top = self.size - 1
        plus, minus, score, low = ones, 0, self.size, self.size
        for c in text:
            eq = self.masks.get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (ones & ~(xh | plus))
            down = plus & xh
            score += ((up >> top) & 1) - ((down >> top) & 1)
            if score < low:
                low = score
            up = (up << 1) & ones
            down = (down << 1) & ones
            plus = down | (ones & ~(xv | up))
            minus = up & xv
        return low


class Matcher:
    """One block of items: piece automaton and patterns."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_piece: int):
        import ahocorasick

        self.items = []
        where: dict[str, list] = defaultdict(list)
        for item_id, text in items:
            t = normal(text)
            if not t:
                continue
            k = errors(len(t), rate, min_piece)
            at = len(self.items)
            self.items.append((item_id, t, k, Pattern(t)))
            for off, p in pieces(t, k):
                where[p].append((at, off))
        self.auto = ahocorasick.Automaton()
        for p, places in where.items():
            self.auto.add_word(p, (len(p), tuple(places)))
        if where:
            self.auto.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Item index -> smallest distance found, at most its errors."""
        out: dict[int, int] = {}
        done: dict[int, list[int]] = {}
        for end, (ln, places) in self.auto.iter(text):
            for at, off in places:
                if out.get(at) == 0:
                    continue
                _, item, k, pattern = self.items[at]
                begin = end - ln + 1 - off
                if text.startswith(item, begin) if begin >= 0 else False:
                    out[at] = 0
                    continue
                tried = done.setdefault(at, [])
                # the window of a place tried before holds this one's, too
                if any(abs(begin - x) <= k for x in tried):
                    continue
                tried.append(begin)
                d = pattern.best(text[max(0, begin - 2 * k):begin + len(item) + 2 * k])
                if d <= k and d < out.get(at, k + 1):
                    out[at] = d
        return out


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list]:
    """The items with text, in blocks of bounded size."""
    items = benchmark.select("item_id", "text").filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for i in range(n):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == i)
        yield [(r.item_id, r.text) for r in part.distinct().collect()]


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.08, min_piece: int = 10,
                      block_chars: int = 1_000_000) -> DataFrame:
    """docs (doc_id, text), benchmark (item_id, text) -> (doc_id, item_id,
    distance, errors): a row per document and item that occurs in it."""
    spark = docs.sparkSession
    ship(spark)
    kinds = (docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString())
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, errors int"
    rows = docs.select("doc_id", "text")

    def scan(items):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = Matcher(shared.value, error_rate, min_piece)
            if not m.items:
                return
            for b in batches:
                ids, text = b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("text"))
                row, item, dist, err = [], [], [], []
                for i in range(len(text)):
                    t = text[i].as_py()
                    for at, d in (m.find(normal(t)) if t else {}).items():
                        row.append(i)
                        item.append(m.items[at][0])
                        dist.append(d)
                        err.append(m.items[at][2])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row, pa.int64())), pa.array(item, b_type), pa.array(dist, pa.int32()),
                     pa.array(err, pa.int32())], ["doc_id", "item_id", "distance", "errors"])

        return rows.mapInArrow(run, schema)

    from pyspark.sql.pandas.types import to_arrow_type
    b_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    found = [scan(items) for items in _blocks(benchmark, block_chars)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
