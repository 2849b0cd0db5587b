"""Per-document counts used by the quality operators (one pass over the text)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm import scan
from marquee.llm.common import ship

WINDOW = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_chars", "n_upper", "n_digits", "n_marks")


def _class(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


SYMBOLS = _class(b"#*$%&|<>")
UPPER = _class(bytes(range(65, 91)))
DIGITS = _class(b"0123456789")
MARKS = _class(b"!?;:=+_~^@{}[]\\/")
#: bytes that begin a code point
HEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _per_doc(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _repeated(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which (doc, hash) occur twice or more."""
    key = scan.mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(h), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    n = len(off) - 1
    w = scan.words(data, off)
    inside = ~scan.SPACE[data]
    out = {"n_words": np.diff(w.first), "word_chars": _per_doc(inside & HEAD[data], off),
           "n_chars": _per_doc(HEAD[data], off)}
    for name, table in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_digits", DIGITS), ("n_marks", MARKS)):
        out[name] = _per_doc(table[data], off)
    # lines that hold a word; runs of bytes other than \n, cut at document ends
    ls, le = scan.runs(data != 10, off)
    has = np.searchsorted(w.start, le) > np.searchsorted(w.start, ls)
    ls, le = ls[has], le[has]
    doc = np.searchsorted(off, ls, "right") - 1
    lh = scan.range_hash(data, ls, le)
    out["n_lines"] = np.bincount(doc, minlength=n)
    key = np.unique(np.stack([doc.astype(np.uint64), lh], 1), axis=0) if len(doc) else np.zeros((0, 2), np.uint64)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(key[:, 0].astype(np.int64), minlength=n)
    at, h = scan.windows(w, WINDOW)
    covered = np.zeros(len(w.start), dtype=bool)
    if len(at):
        hit = at[_repeated(w.doc[at], h)]
        for j in range(WINDOW):
            covered[hit + j] = True
    out["n_repeat_words"] = np.bincount(w.doc[covered], minlength=n) if len(w.doc) else np.zeros(n, np.int64)
    return out


def _batches(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = b.column(b.schema.get_field_index("text"))
        kept = [(f.name, b.column(i)) for i, f in enumerate(b.schema) if f.name != "text"]
        for lo, hi, data, off in scan.slices(text):
            c = counts(data, off)
            yield pa.RecordBatch.from_arrays(
                [v.slice(lo, hi - lo) for _, v in kept] + [pa.array(c[k], pa.int64()) for k in COUNTS],
                [k for k, _ in kept] + list(COUNTS))


def document_counts(docs: DataFrame) -> DataFrame:
    """Replace ``text`` by the counts in ``COUNTS`` (null text: all zero)."""
    ship(docs.sparkSession)
    kept = [f for f in docs.schema if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{c} long" for c in COUNTS)])
    return docs.mapInArrow(_batches, schema)
