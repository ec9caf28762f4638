"""Near-duplicates by min-max hashing of word shingles.

Every permutation of a document's shingle set gives two values of its signature, the minimum and the maximum, so
``2 * PERMUTATIONS`` values cost ``PERMUTATIONS`` hash evaluations. The signature is cut into bands of ``ROWS`` values; documents
that agree in a band are candidates. With 40 bands of 5 values, two sets of Jaccard similarity 0.75 miss each
other with probability 2e-5, of 0.8 with 1e-7. Candidates are confirmed on their full sets.

1. Documents with equal sets form one class; only classes go on (a group of exact copies is one row).
2. Each class is compared with the smallest one that it shares a bucket with, which joins most of a large group at once.
3. Twice, the largest component of each bucket is asked by the classes of the bucket that are not in it: they are compared with
   all its members. What they ask is settled, so those in the component leave the bucket. What remains is compared among itself.
   No link between classes of one bucket is lost, and no pair becomes a row: members are held in blocks with an index of their
   shingles, those who ask pass by, and only links that join something come out.

Sets and classes are told apart by 64-bit shingle hashes and 128-bit set hashes.

Defined results: null text and text without words have the empty set and are linked with nothing; fewer words than a shingle are one
shingle; rows without an id are linked with nothing, have no component and are kept; copies of an id are nodes of their own; an empty
table gives an empty one; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, settled, small_batches
from .components import connected

WORDS, PERMUTATIONS, ROWS = 5, 100, 5
THRESHOLD = 75  # of 100
BROADCAST_IDS = 1_000_000
BLOCK, ROUNDS_OF_ASKING = 1024, 2
#: Shingles of a block, shared ones counted for each set, and shared shingles that an ask counts at a time.
BLOCK_SHINGLES, HITS = 1 << 20, 1 << 18
#: Bytes of a text that are read at a time.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_P, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PIECE = 4096


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_P, 1 << 16), _powers(_INVERSE, 1 << 16)


def _mix(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of some bytes."""
    global _UP, _DOWN
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if len(raw) > len(_UP):
        n = 1 << int(len(raw)).bit_length()
        _UP, _DOWN = _powers(_P, n), _powers(_INVERSE, n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _UP[: len(raw)])])
    return _mix((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text, which is read in blocks that end at white space."""
    raw = np.frombuffer((text or "").encode().lower(), np.uint8)  # bytes: only A-Z change
    parts, at = [], 0
    while at < len(raw):
        end = at + BLOCK_BYTES
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        parts.append(_word_hashes(raw[at:end]))
        at = end
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(h):
        return h
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out * _MIX + h[i : len(h) - k + 1 + i])
    return np.unique(out)


_RANDOM = np.random.default_rng(20)
_A = _RANDOM.integers(0, 1 << 64, PERMUTATIONS, np.uint64, False) | np.uint64(1)
_B = _RANDOM.integers(0, 1 << 64, PERMUTATIONS, np.uint64, False)


def signature(s: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the set under each permutation."""
    low, high = np.full(PERMUTATIONS, np.uint64((1 << 64) - 1)), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(s), _PIECE):
        h = _A[:, None] * s[at : at + _PIECE] + _B[:, None]
        np.minimum(low, h.min(1), low)
        np.maximum(high, h.max(1), high)
    return np.concatenate([low, high])


def bands(s: np.ndarray) -> np.ndarray:
    rows = signature(s).reshape(-1, ROWS)
    out = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for i in range(ROWS):
        out = _mix(out * _MIX + rows[:, i])
    return out.view(np.int64)


def _set_id(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _described(rows: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set (null when empty), bands of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            cols = [
                pa.array(list(map(len, sets)), pa.int64()),
                pa.array([_set_id(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([bands(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "n_shingles", "set", "bands"])

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, n_shingles long, set binary, bands array<long>")


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """set, shingles (binary) of the documents whose id is wanted."""
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([_set_id(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["set", "shingles"])

    return rows.join(wanted, "doc_id", "left_semi").mapInArrow(work, "set binary, shingles binary")


class _Members:
    """The sets of one block of a group, indexed by shingle."""

    def __init__(self, names: list[bytes], sets: list[np.ndarray], joined: bool):
        self.names, self.sizes = names, np.array(list(map(len, sets)))
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], owner[order]
        self.root: dict[bytes, bytes] = {}
        self.joined = joined

    def _find(self, x: bytes) -> bytes:
        while (up := self.root.get(x, x)) != x:
            self.root[x] = x = self.root.get(up, up)
        return x

    def links(self, name: bytes, s: np.ndarray, threshold: int) -> Iterator[tuple[bytes, bytes]]:
        """Confirmed links of a set to the members, without those that join what is joined already."""
        low, high = np.searchsorted(self.every, s, "left"), np.searchsorted(self.every, s, "right")
        both = np.zeros(len(self.sizes), np.int64)
        ends = np.cumsum(high - low)
        start = 0
        while start < len(s):  # some shingles of the set at a time
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HITS, "right")))
            n = (high - low)[start:stop]
            at = np.repeat(low[start:stop] - np.cumsum(n) + n, n) + np.arange(n.sum())
            both += np.bincount(self.owner[at], minlength=len(self.sizes))
            start = stop
        for i in np.flatnonzero(100 * both >= threshold * (self.sizes + len(s) - both)):
            other = self.names[i]
            if other == name:
                continue
            if self.joined:
                yield name, other
                return
            a, b = self._find(name), self._find(other)
            if a != b:
                self.root[a] = b
                yield name, other


def _compared(asks: DataFrame, members: DataFrame, sets: DataFrame, sizes: DataFrame, joined: bool, threshold: int) -> DataFrame:
    """Links (a, b) between the sets that ask a group and the members of the group, (group, set) both; sets: set, shingles; sizes: set, n.

    Members come in blocks of about ``BLOCK`` sets or ``BLOCK_SHINGLES`` shingles, whichever is less; those who ask meet every block, so nothing holds a whole group and no pair is
    a row. ``joined``: the members of a group are one component already, so one link for each ask is enough.
    """
    held = members.join(sizes, "set").select("group", "set", F.lit(0).alias("asks"), "n")
    rows = held.unionByName(asks.select("group", "set", F.lit(1).alias("asks"), F.lit(0).cast(dict(held.dtypes)["n"]).alias("n")))
    blocks = held.groupBy("group").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    own = F.array(F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    every = F.when(F.col("asks") == 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own)
    rows = rows.join(blocks, "group").select("group", F.explode(every).alias("block"), "asks", "set")
    rows = rows.join(sets, "set").select("group", "block", "asks", "set", "shingles")
    rows = rows.repartition(F.col("group"), F.col("block")).sortWithinPartitions("group", "block", "asks", "set")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, held, index = None, [], [], None
        for batch in batches:
            out: list[tuple[bytes, bytes]] = []
            for group, block, ask, name, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                if key != (group, block):
                    key, names, held, index = (group, block), [], [], None
                s = np.frombuffer(raw.as_buffer(), np.uint64)
                if not ask:
                    names.append(name)
                    held.append(s.copy())
                elif names:
                    if index is None:
                        index, held = _Members(names, held, joined), []
                    out += index.links(name, s, threshold)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])

    return rows.mapInArrow(work, "a binary, b binary")


def components(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    about = checkpoint(_described(rows))
    able = about.filter("set is not null and doc_id is not null")
    classes = checkpoint(able.groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n")))
    # classes in band buckets; buckets of one class are left out
    by_band = classes.select(F.explode("bands").alias("band"), "set")
    shared = by_band.groupBy("band").agg(F.min("set").alias("least"), F.count("*").alias("size")).filter("size > 1").drop("size")
    bucket = settled(by_band.join(shared, "band"))
    nodes = settled(bucket.groupBy("set").agg(F.min("least").alias("least")))
    sets = settled(_sets(rows, classes.join(nodes, "set", "left_semi").select("doc_id").distinct()).dropDuplicates(["set"]), 10_000)

    weights = settled(nodes.select("set").join(classes.select("set", "n"), "set"))

    # each class with the smallest one that it shares a bucket with
    star = nodes.filter("set <> least").select(F.col("least").alias("group"), "set")
    root = settled(connected(_compared(star, star.select("group", F.col("group").alias("set")).distinct(), sets, weights, True, threshold)))

    left = bucket.select("band", "set")
    for _ in range(ROUNDS_OF_ASKING):
        # the largest component of each bucket is asked by the classes of the bucket that are not in it
        placed = left.join(root.select(F.col("node").alias("set"), "root"), "set", "left").withColumn("root", F.coalesce("root", "set"))
        sizes = root.groupBy("root").agg(F.count("*").alias("size"))
        placed = settled(placed.join(sizes, "root", "left").withColumn("size", F.coalesce("size", F.lit(1))))
        largest = placed.groupBy("band").agg(F.max(F.struct("size", "root")).alias("top")).select("band", F.col("top.root").alias("group"))
        left = settled(placed.join(largest, "band").filter("root <> group").select("band", "set", "group"))
        if left.isEmpty():
            break
        asks = left.select("group", "set").distinct()
        groups = asks.select("group").distinct()
        members = groups.join(root.select(F.col("root").alias("group"), F.col("node").alias("set")), "group", "left").withColumn("set", F.coalesce("set", "group"))
        links = _compared(asks, members, sets, weights, True, threshold)
        left = left.select("band", "set")
        root = settled(connected(root.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)))
    else:
        # classes that no round took out of their bucket: compared among themselves, bucket by bucket
        placed = left.join(root.select(F.col("node").alias("set"), "root"), "set", "left").withColumn("root", F.coalesce("root", "set"))
        mixed = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("band")
        rest = settled(placed.join(mixed, "band", "left_semi").select(F.col("band").alias("group"), "set"))
        if not rest.isEmpty():
            links = _compared(rest, rest, sets, weights, False, threshold)
            root = settled(connected(root.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)))

    least = root.join(classes.select(F.col("set").alias("node"), "doc_id"), "node").groupBy("root").agg(F.min("doc_id").alias("least"))
    least = root.join(least, "root").select(F.col("node").alias("set"), "least")
    placed = classes.select("set", F.col("doc_id").alias("first")).join(least, "set", "left").select("set", F.coalesce("least", "first").alias("component"))
    out = about.select("doc_id", "n_shingles", "set").join(placed, "set", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of docs that stay: one of each component; rows without an id stay, of copies of an id one stays. Columns of docs may have any names."""
    from pyspark.sql import Window

    longest = max(map(len, docs.columns))
    gone_id, number = "gone".ljust(longest + 1, "_"), "first".ljust(longest + 2, "_")  # names that docs cannot have
    gone = components(docs, threshold).filter("not kept").select(F.col("doc_id").alias(gone_id)).distinct()
    left = docs.join(gone, docs["doc_id"] == F.col(gone_id), "left_anti")
    first = Window.partitionBy("doc_id").orderBy("text")
    kept = left.withColumn(number, F.row_number().over(first)).filter((F.col(number) == 1) | F.col("doc_id").isNull())
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


ORACLE = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {WORDS - 1}], ' ') AS s FROM places),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= {THRESHOLD} * (x.n + y.n - both_n)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1)
SELECT d.doc_id AS doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
