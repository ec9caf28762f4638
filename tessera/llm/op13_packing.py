"""Best-fit packing of token pieces into sequences of a fixed capacity, in bulk-synchronous rounds.

A document is its ids by byte-level BPE and an end id; a document longer than the capacity is cut into pieces of the whole capacity, a shorter one being the first. Pieces of equal length are
alike to a packing, so they get ranks within their length (salted counts, then row numbers within a salt) and travel as runs (length, first rank, how many); so do sequences of
equal gap (gap, first sequence, how many). There are never more runs than lengths and splits of runs, whatever the number of documents.

A round range-sorts the runs of pieces and gaps by size and sweeps each range upwards: a gap takes the longest piece seen that no smaller gap took, which is the piece whose best
fit it is; of pieces that want the same gap the longer one ranks first, and runs split by rank. A gap that holds several pieces of that length takes as many as fit. What a range leaves
open (pieces no gap there holds, gaps no piece there fits) goes on to the next superstep, where ranges are merged, up to one sweep over all that is left. Then the gaps are
updated, and the next round begins. It opens as many sequences as the open tokens need at least; other sequences are only opened when no open piece
fits any gap, again as many as are needed at least (by tokens, and by the pieces longer than a half, a third, ... of a sequence).
A task of a superstep holds runs, not documents; the plan of all rounds is bounded in the same way and is broadcast to place the ranked pieces.

Ids come from two libraries with one vocabulary: a fast one for ordinary text, in blocks that end before white space, and the one that defines the result for blocks that hold the
special token's string or very long white space. The tests compare both on every code point.

Defined cases: null and empty texts are one piece, the end id; repeated rows are packed as often as they occur; equal lengths are ranked by id, piece and checksum; the empty table
has no rows; columns other than doc_id and text are not read; texts of any length are read in blocks.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, scratch_path, small_batches

CAPACITY, END = 1024, 2
#: Sizes of one range of a sweep, and how many ranges the next superstep merges.
RANGE = 32
#: Pieces that share one salt of a length.
SALT_ROWS = 200_000
#: Bits of a rank within its length; lengths have the others.
RANK_BITS = 44
#: Characters that are encoded at a time.
BLOCK = 1 << 20

#: The pattern that cuts texts for this vocabulary, and its special token.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"
_SLOW = re.compile(r"\s{5000}")
_EDGE = re.compile(r"(?<=\S)(?=\s)")


def blocks(text: str) -> Iterator[str]:
    """The text in blocks that start with white space behind something else, where tokens never run across."""
    start = 0
    while len(text) - start > BLOCK:
        edge = _EDGE.search(text, start + BLOCK)
        if not edge:
            break
        yield text[start : edge.start()]
        start = edge.start()
    yield text[start:]


class Encoder:
    """Ids of a text as the ``tokenizers`` library gives them."""

    _all: dict = {}

    def __init__(self, tokenizer_file: str, ranks_file: str | None):
        import tokenizers

        self.exact, self.fast = tokenizers.Tokenizer.from_file(tokenizer_file), None
        if ranks_file:
            import tiktoken

            with open(ranks_file, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, *files) -> Encoder:
        if files not in cls._all:
            cls._all[files] = cls(*files)
        return cls._all[files]

    def encode(self, text: str) -> np.ndarray:
        out = []
        for block in blocks(text):
            if self.fast is None or SPECIAL in block or _SLOW.search(block):
                out.append(self.exact.encode(block, add_special_tokens=False).ids)
            else:
                out.append(self.fast.encode_ordinary(block))
        return np.concatenate([np.asarray(ids, "<u4") for ids in out])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all but the first fill a sequence."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def encode_pieces(docs: DataFrame, tokenizer_file: str, ranks_file: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer_file, ranks_file)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encoder.encode(text.as_py()), np.uint32(end)).astype("<u4")
                for k, (a, n) in enumerate(cut(len(ids), capacity)):
                    at.append(i), piece.append(k), start.append(a), length.append(n), crc.append(zlib.crc32(ids[a : a + n]))
            cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long")


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """The pieces with ``rank`` from 0 within their length; no length is numbered in one task."""
    salts = max(1, -(-rows // SALT_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("number", F.row_number().over(order))
    return numbered.join(before, ["length", "salt"]).select(*pieces.columns, (F.col("before") + F.col("number") - 1).alias("rank"))


# Rounds over runs. kind 0: pieces (size, first rank, n); 1: gaps (size, first sequence, n); 2: placed pieces (size, first rank, n) in
# sequences from ``sequence`` on, ``each`` in every one, with the gap they found; 3: gaps as the round has changed them.

RUN = "kind int, size long, start long, n long, sequence long, gap long, each long"
NAMES = [c.split()[0] for c in RUN.split(", ")]


def sweep(runs: list[tuple]) -> list[tuple]:
    """One sweep over runs by rising size, pieces before gaps of the same size; what is not matched stays as it is."""
    out = [r for r in runs if r[0] > 1]
    stack: list[list[int]] = []
    for kind, size, start, n, *_ in sorted((r for r in runs if r[0] < 2), key=lambda r: (r[1], r[0], -r[2] if r[0] == 0 else r[2])):
        if kind == 0:
            stack.append([size, start, n])
            continue
        while n and stack:
            length, rank, left = stack[-1]
            each = min(size // length, left)
            gaps = min(n, left // each)
            out.append((2, length, rank, gaps * each, start, size, each))
            if size > each * length:
                out.append((3, size - each * length, start, gaps, None, None, None))
            start, n = start + gaps, n - gaps
            if left > gaps * each:
                stack[-1][1:] = [rank + gaps * each, left - gaps * each]
            else:
                stack.pop()
        if n:
            out.append((1, size, start, n, None, None, None))
    return out + [(0, length, rank, left, None, None, None) for length, rank, left in stack]


def _superstep(runs: DataFrame, span: int) -> DataFrame:
    """Sweeps of ranges of ``span`` sizes; placed runs and changed gaps pass through by themselves."""

    def work(group: pd.DataFrame) -> pd.DataFrame:
        rows = [(*map(int, r[:4]), *(None if pd.isna(x) else int(x) for x in r[4:])) for r in group[NAMES].itertuples(index=False)]
        return pd.DataFrame(sweep(rows), columns=NAMES).astype({"kind": "int32", **dict.fromkeys(NAMES[1:4], "int64"), **dict.fromkeys(NAMES[4:], "Int64")})

    key = F.when(F.col("kind") < 2, F.floor((F.col("size") - 1) / span)).otherwise(-1 - F.floor((F.col("size") - 1) / span))
    return runs.groupBy(key.alias("range")).applyInPandas(work, RUN)


def needed(lengths: list[tuple[int, int]], capacity: int, room: int = 0) -> int:
    """Sequences that pieces (length, how many) need at least, by their tokens beyond ``room``, or by those of which j and not more go into one."""
    tokens = max(0, sum(length * n for length, n in lengths) - room)
    by_count = [-(-sum(n for length, n in lengths if length * (j + 1) > capacity) // j) for j in range(1, 9)] if not room else []
    return max(-(-tokens // capacity), *by_count, 0)


def plan(lengths: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame | None, int]:
    """(placed runs, number of sequences) of pieces given as (length, n), one row for each length."""
    spark = lengths.sparkSession
    state = checkpoint(lengths.select(F.lit(0).alias("kind"), F.col("length").alias("size"), F.lit(0).cast("long").alias("start"), "n", *(F.lit(None).cast("long").alias(c) for c in NAMES[4:])))
    placed, sequences = [], 0
    while True:
        sizes = state.groupBy("kind", "size").agg(F.sum("n").alias("n")).collect()  # two rows a size at most
        pieces = [(r["size"], r.n) for r in sizes if r.kind == 0]
        gaps = [(r["size"], r.n) for r in sizes if r.kind == 1]
        if not pieces:
            break
        fits = min(length for length, _ in pieces) <= max((gap for gap, _ in gaps), default=0)
        new = needed(pieces, capacity, sum(gap * n for gap, n in gaps) if fits else 0)
        if new:
            opened = spark.createDataFrame([(1, capacity, sequences, new, None, None, None)], RUN)
            state, sequences = state.unionByName(opened), sequences + new
        span = RANGE
        while True:
            state = _superstep(state, span)
            if span >= capacity:
                break
            span *= RANGE
        done = checkpoint(state)
        placed.append(done.filter("kind = 2").drop("kind"))
        state = done.filter("kind <> 2").withColumn("kind", F.when(F.col("kind") == 3, 1).otherwise(F.col("kind")))
    out = None
    for one in placed:
        out = one if out is None else out.unionByName(one)
    return out, sequences


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    path = scratch_path(pieces.sparkSession, "op13")
    pieces.write.parquet(path)
    kept = pieces.sparkSession.read.schema(pieces.schema).parquet(path)
    lengths = checkpoint(kept.groupBy("length").agg(F.count("*").alias("n")))
    rows = lengths.agg(F.sum("n")).first()[0] or 0
    schema = ", ".join(f"`{c}` {k}" for c, k in kept.dtypes) + ", sequence_id long, offset long"
    placed, _ = plan(lengths, capacity)
    if placed is None:
        return pieces.sparkSession.createDataFrame([], schema)
    runs = placed.orderBy("size", "start").toPandas()  # runs: bounded by lengths and rounds, not by documents
    size, start, sequence, gap, each = (runs[c].to_numpy(np.int64) for c in ("size", "start", "sequence", "gap", "each"))
    table = pieces.sparkSession.sparkContext.broadcast((size, start, sequence, gap, each))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, start, sequence, gap, each = table.value
        by = size << RANK_BITS | start  # runs lie by length, then rank
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(by, length << RANK_BITS | rank, "right") - 1
            i = rank - start[at]
            cols = [*batch.columns[:-1], pa.array(sequence[at] + i // each[at]), pa.array(capacity - gap[at] + i % each[at] * length)]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked(kept, rows).mapInArrow(work, schema)
