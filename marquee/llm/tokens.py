"""Token counts by separator scan over flat token files (operator 6).

A flat token file is a row of 16-bit big-endian token ids without an index;
``EOD`` ends each document.  Counting reads the files in blocks:

1. *Scan.*  Each block is one array; a vectorised comparison finds its
   separators.  A block knows its documents that begin and end inside it,
   the place of its first separator, and the place after its last one.
2. *Stitch.*  The document cut by block edges is completed by a prefix scan
   over the blocks' summaries (one small row per block): the last known
   beginning is carried forward to the next block that holds a separator.

Documents may carry a header of five 15-bit words with their id, which can
never hold a separator (the first word's highest bit stands for a null id); blocks read a few bytes more than their length, so
a header cut by a block edge is seen whole.  A last document without a
separator counts up to the end of its file.

:func:`write_token_files` makes such files with Spark's text sink: a record
is a document's bytes and the record separator is the two bytes of ``EOD``,
an id free in the vocabulary that happens to be a UTF-8 character.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import ship
from marquee.session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: as bytes C4 80, the UTF-8 form of U+0100
EOD, EOD_TEXT = 0xC480, "Ā"
HEADER = 5
BLOCK_BYTES = 1 << 20


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoding(ranks: dict[bytes, int]):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


#: in the first word, whose id part has four bits
NULL_ID = 0x4000


def header(doc_id: int | None) -> list[int]:
    """An id as five 15-bit words, the highest first."""
    if doc_id is None:
        return [NULL_ID] + [0] * (HEADER - 1)
    v = doc_id & 0xFFFFFFFFFFFFFFFF
    return [(v >> (15 * k)) & 0x7FFF for k in range(HEADER - 1, -1, -1)]


def _token_bytes(batches, ranks) -> Iterator[pa.RecordBatch]:
    enc = _encoding(ranks)
    for big in batches:
        for lo in range(0, big.num_rows, 500):
            b = big.slice(lo, 500)
            ids = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            out = []
            for i, t in zip(ids, b.column(b.schema.get_field_index("text")).to_pylist()):
                tok = enc.encode_ordinary(t) if t else []
                out.append(np.array(header(i) + tok, dtype=">u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """docs (doc_id, text) -> flat token files under ``path``, a document per
    row: repeated rows and rows with a null id too; a null text is empty."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_ranks(vocabulary))  # the size of the vocabulary
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    coded = rows.mapInArrow(lambda it: _token_bytes(it, shared.value), "value binary")
    # the sink writes the bytes as they are
    coded.select(F.col("value").cast("string")).write.option("lineSep", EOD_TEXT).text(path)


def _scan(batches) -> Iterator[pa.RecordBatch]:
    """Blocks (file, at, size, bytes) -> documents and block summaries.

    kind 0: a whole document; 1: a document that begins here and is open at
    the end; 2: the first separator of a block.  Places count tokens.
    """
    for b in batches:
        cols = {n: [] for n in ("file", "block", "kind", "place", "doc_id", "n_tokens")}

        def add(f, k, kind, place, doc, n):
            for c, v in zip(cols, (f, k, kind, place, doc, n)):
                cols[c].append(v)

        for f, k, at, size, whole, raw in zip(*(b.column(b.schema.get_field_index(c)).to_pylist()
                                                for c in ("file", "block", "at", "size", "whole", "bytes"))):
            tok = np.frombuffer(raw[:len(raw) // 2 * 2], dtype=">u2").astype(np.int64)
            own = size // 2
            sep = np.flatnonzero(tok[:own] == EOD)
            begin = np.concatenate([[0] if k == 0 else [], sep + 1]).astype(np.int64)
            # a beginning after the file's last token is no document
            begin = begin[at // 2 + begin < whole // 2]
            ids = np.zeros(len(begin), dtype=np.uint64)
            for j in range(HEADER):
                ids = (ids << np.uint64(15)) | tok[np.minimum(begin + j, len(tok) - 1)].astype(np.uint64)
            null = tok[np.minimum(begin, len(tok) - 1)] & NULL_ID > 0
            ids = np.where(null, None, ids.view(np.int64))
            if len(sep):
                add(f, k, 2, at // 2 + int(sep[0]), None, None)
            nxt = np.searchsorted(sep, begin)
            for d, p, e in zip(ids.tolist(), begin.tolist(), nxt.tolist()):
                if e < len(sep):
                    add(f, k, 0, at // 2 + p, d, int(sep[e]) - p - HEADER)
                else:
                    add(f, k, 1, at // 2 + p, d, whole // 2 - (at // 2 + p) - HEADER)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols["file"], pa.string()), pa.array(cols["block"], pa.int64()), pa.array(cols["kind"], pa.int32()),
             pa.array(cols["place"], pa.int64()), pa.array(cols["doc_id"], pa.int64()),
             pa.array(cols["n_tokens"], pa.int64())], list(cols))


def count_tokens(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Flat token files -> (file, place, doc_id, n_tokens), a row per document.

    ``block_bytes`` must be even.  ``place`` is the document's first token.
    """
    ship(spark)
    look = 2 * HEADER
    files = spark.read.format("binaryFile").load(path).select(
        F.regexp_extract("path", "[^/]*$", 0).alias("file"), F.col("length").alias("whole"), "content")
    last = F.floor((F.col("whole") - 1) / block_bytes)
    blocks = files.filter("whole > 0").select("file", "whole", F.inline(F.transform(
        F.sequence(F.lit(0).cast("long"), last), lambda k: F.struct(
            k.alias("block"), (k * block_bytes).alias("at"),
            F.least(F.lit(block_bytes).cast("long"), F.col("whole") - k * block_bytes).alias("size"),
            F.substring("content", (k * block_bytes + 1).cast("int"), F.lit(block_bytes + look)).alias("bytes")))))
    rows = blocks.mapInArrow(_scan, "file string, block long, kind int, place long, doc_id long, n_tokens long")
    # the prefix scan: an open document ends at the first separator of a later
    # block; one row per block with a separator or an open document
    open_ = rows.filter("kind > 0")
    # in a block its first separator comes before the document it leaves open
    edge = Window.partitionBy("file").orderBy("block", F.desc("kind")).rowsBetween(1, Window.unboundedFollowing)
    ends = F.first(F.when(F.col("kind") == 2, F.col("place")), ignorenulls=True).over(edge)
    stitched = open_.withColumn("end", ends).filter("kind = 1").select(
        "file", "place", "doc_id", F.coalesce(F.col("end") - F.col("place") - HEADER, F.col("n_tokens")).alias("n_tokens"))
    return rows.filter("kind = 0").select("file", "place", "doc_id", "n_tokens").unionByName(stitched)


def document_token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write the documents as flat token files and count them from there."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, vocabulary)
    return count_tokens(spark, path, block_bytes)
