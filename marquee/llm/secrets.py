"""Operator 12: secret scan with multipart credential linking.

Base kinds stand for themselves: assignments to secret-like names, cloud
access ids and long hex strings.  Weak parts (a bare 40-character key or a
password-like assignment, an account identifier, an endpoint) prove nothing
alone; they are reported only where complementary parts co-occur.  Parts are
joined as intervals: a part's window is its span widened by ``reach`` code
points, clipped to its scope (the text between two blank lines).

* a weak secret is reported if an identifier (weak, or an access id) meets its window,
* a weak identifier if a secret (weak, an assignment or a hex string) does,
* an endpoint if both do.

Parts of one kind do not overlap, so their starts and ends ascend together and
the join is one binary search for each part and kind: no pairs are listed,
and every pattern takes time linear in the text.

Defined results: a null text is empty and gives a row without spans; a null
doc_id stays null; repeated rows give a row each; spans with equal starts are
ordered by kind; an empty table gives an empty result.  Only ``doc_id`` and
``text`` are read, so further columns cannot clash.  Texts are taken whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.common import ship

_SET = r"[\"']?\x20*[:=]\x20*[\"']?"
#: kind -> pattern, in the order of the results; group "value", if any, with its least length
PATTERNS = {
    "assign": (re.compile(rf"(?ai:password|passwd|secret|token|api_?key){_SET}(?P<value>[A-Za-z0-9+/_.=-]+)"), 8),
    "access": (re.compile(r"(?P<value>AKIA[A-Z0-9]+)"), 16),
    "hex": (re.compile(r"(?P<value>[0-9a-f]+)"), 32),
    "secret": (re.compile(
        rf"(?ai:pwd|pass|passphrase|credentials?|private_?key|access_?key|auth){_SET}(?P<value>[A-Za-z0-9+/_.=!@#$%^&*-]+)"
        r"|(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-]))"
        r"(?=[A-Za-z+/]{0,39}[0-9])(?=[a-z0-9+/]{0,39}[A-Z])(?=[A-Z0-9+/]{0,39}[a-z])(?P<bare>[A-Za-z0-9+/]{40})"), 6),
    "identifier": (re.compile(
        rf"(?ai:user(?:_?name|_?id)?|login|client_?id|account(?:_?id)?|key_?id){_SET}(?P<value>[A-Za-z0-9._@+-]+)"), 3),
    "endpoint": (re.compile(
        r"(?ai:https?|ftps?|s3|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|ssh)://(?P<value>[^\x00-\x20\"'<>]+)"
        rf"|(?ai:host(?:name)?|server|endpoint){_SET}(?P<bare>[A-Za-z0-9.:/-]+)"), 4),
}
BASE = ("assign", "access", "hex")
KINDS = tuple(PATTERNS)
IDENTIFIERS, SECRETS = ("access", "identifier"), ("assign", "hex", "secret")
_HEX = re.compile(r"[0-9a-f]{32,}")
_BLANK_LINE = re.compile(r"\n[ \t\r]*(?=\n)")

SPANS = "array<struct<kind: string, start: long, end: long>>"


def find_parts(text: str) -> dict[str, np.ndarray]:
    """kind -> (start, end) rows: leftmost non-overlapping matches, those with a short value dropped."""
    out = {}
    for kind, (pattern, least) in PATTERNS.items():
        if kind == "hex":  # the runs of 32 and more, without a stop at each shorter one
            found = [m.span() for m in _HEX.finditer(text)]
        else:
            found = [m.span() for m in pattern.finditer(text)
                     if len(m.group("value") or m.groupdict().get("bare") or "") >= least]
        out[kind] = np.array(found, np.int64).reshape(-1, 2)
    return out


def linked(text: str, parts: dict[str, np.ndarray], reach: int) -> dict[str, np.ndarray]:
    """The weak parts whose complementary parts lie within their window."""
    edges = np.array([m.end() for m in _BLANK_LINE.finditer(text)], np.int64)

    def meets(spans: np.ndarray, kinds: tuple[str, ...]) -> np.ndarray:
        at = np.searchsorted(edges, spans[:, 0], "right")
        low = np.maximum(spans[:, 0] - reach, np.append(0, edges)[at])
        high = np.minimum(spans[:, 1] + reach, np.append(edges, len(text))[at])
        hit = np.zeros(len(spans), bool)
        for other in (parts[k] for k in kinds):
            first = np.searchsorted(other[:, 1], low, "right")
            there = first < len(other)
            hit[there] |= other[first[there], 0] < high[there]
        return hit

    secret, identifier, endpoint = parts["secret"], parts["identifier"], parts["endpoint"]
    return {"secret": secret[meets(secret, IDENTIFIERS)], "identifier": identifier[meets(identifier, SECRETS)],
            "endpoint": endpoint[meets(endpoint, IDENTIFIERS) & meets(endpoint, SECRETS)]}


def _sorted(parts: dict[str, np.ndarray], kinds: tuple[str, ...]) -> list[dict]:
    rows = sorted((int(s), k, int(e)) for k, kind in enumerate(KINDS) if kind in kinds for s, e in parts[kind])
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in rows]


def _scan(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        counts: dict[str, list[int]] = {k: [] for k in BASE}
        base, spans = [], []
        for text in b.column(1):
            text = text.as_py() or ""
            parts = find_parts(text)
            for k in BASE:
                counts[k].append(len(parts[k]))
            base.append(_sorted(parts, BASE))
            if any(len(parts[k]) for k in KINDS[len(BASE):]):
                spans.append(_sorted({**parts, **linked(text, parts, reach)}, KINDS))
            else:
                spans.append(base[-1])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(base, span), pa.array(spans, span)],
            ["doc_id", "n_assign", "n_access", "n_hex", "base", "spans"])


def scan_secrets(docs: DataFrame, reach: int = 400) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base and spans (kind, start, end in code points, end exclusive).

    ``base`` holds the base kinds' spans, ``spans`` these and the linked weak parts.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _scan(it, reach),
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base {SPANS}, spans {SPANS}")
