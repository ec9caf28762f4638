"""Exact removal of repeated byte strings, by sampled suffixes, names of triples and a merge of the remaining suffixes.

The plan is that of difference-cover suffix sorting, cut down to what strings of ``LENGTH`` bytes need:

* **Names.** The name of the 3 bytes at a position comes from its triple of bytes, that of 9 bytes from the triple of names three
  apart, and so on to 27, 81 and 243: equal strings have equal names. Names are 64-bit fingerprints and not ranks,
  so they are the same on every executor and the recursion needs neither a sort nor a shuffle.
* **Sample.** Every string of ``LENGTH`` bytes holds exactly one sampled position: the one whose ``GRAM`` bytes have the least
  name (the leftmost of equals). Equal strings have it at the same offset, which is what a difference cover gives, with
  about one sample in 120 positions instead of two in three. Strings that share their sampled position form a run; only
  runs are sorted: by the name of the sampled bytes, then by the name of the whole run. A run whose sampled bytes
  are nowhere else has no repeated string; a run that is somewhere else as a whole has only repeated ones.
* **Merge.** What remains, the strings of the other runs (and of one run of each repeated class, as their possible
  partners), is sorted by sampled name and own name, and adjacent ones are compared.

Positions within a run travel packed in one row. Runs and strings that repeat inside one batch are counted before the shuffle, so
a group of copies costs one row for each batch, and the strings of a sample that very many runs share are dealt into parts by name. Texts are written once, bucketed by row, and met by the results of each step without
being shuffled. A text is read whole, in overlapping pieces.

Defined results: null text counts as empty; texts shorter than ``LENGTH`` keep all bytes; overlapping repetitions within a text count;
repeated rows are documents of their own, so they remove each other; ids may be null or repeated; an empty table gives an
empty one; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, scratch_path, small_batches

LENGTH, GRAM = 400, 160
PIECE, BUFFER = 1 << 21, 1 << 22
BUCKET_BYTES, MOST_FILES, PART_RUNS = 24_000_000, 20_000, 5000

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_LOW = np.uint64((1 << 30) - 1)


def _triple(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = a * _C[0]
    h += b * _C[1]
    h ^= h >> np.uint64(29)
    h += c
    h *= _C[2]
    h ^= h >> np.uint64(32)
    return h


def names_81(raw: np.ndarray) -> np.ndarray:
    """Names of the 81 bytes from each position."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * _C[3]
    for step in (1, 3, 9, 27):
        h = _triple(h[: len(h) - 2 * step], h[step : len(h) - step], h[2 * step :])
    return h


def names_at(n81: np.ndarray, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Names of the strings of ``length`` bytes (243 to 729) from the positions given."""
    of = lambda p: _triple(n81[p], n81[p + 81], n81[p + 162])
    last = at + length - 243
    return _triple(of(at), of((at + last) // 2), of(last)) * _C[1] + np.asarray(length).astype(np.uint64)


def sampled(raw: np.ndarray, n81: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each string of ``length`` bytes, its sampled position; and the name of the ``gram`` bytes there."""
    n = len(raw) - gram + 1
    g = _triple(n81[:n], n81[gram - 81 : gram - 81 + n], np.zeros(1, np.uint64))
    width = length - gram + 1
    packed = np.full(-(-n // width) * width, np.uint64((1 << 64) - 1))
    packed[:n] = (g & ~_LOW) | np.arange(n, dtype=np.uint64)
    table = packed.reshape(-1, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    m = len(raw) - length + 1
    place = (np.minimum(behind[:m], ahead[width - 1 : width - 1 + m]) & _LOW).astype(np.int64)
    return place, g


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of half-open intervals that overlap or touch, in order."""
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    new = np.concatenate([[True], start[1:] > end[:-1]]) if len(start) else np.zeros(0, bool)
    return start[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])] if len(start) else end


def _pieces(ids: list[int], texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (row, offset, bytes) of up to ``BUFFER`` bytes; pieces of a text overlap by one string less a byte."""
    out, size = [], 0
    for i, t in zip(ids, texts):
        for at in range(0, max(len(t) - length + 1, 0), PIECE):
            piece = t[at : at + PIECE + length - 1]
            if size + len(piece) > BUFFER and out:
                yield out
                out, size = [], 0
            out.append((i, at, piece))
            size += len(piece)
    if out:
        yield out


def runs(pieces: list[tuple[int, int, bytes]], length: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of the pieces: row, p (first start), n (strings), a (name of the sample), u (name of the run), c (occurrences here).

    Of runs that are equal only the first is given; what all of them cover is given as intervals, with c = 0.
    """
    raw = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    sizes = np.array([len(p) for _, _, p in pieces])
    base = np.cumsum(sizes) - sizes
    n81 = names_81(raw)
    place, g = sampled(raw, n81, length, gram)
    owner = np.repeat(np.arange(len(pieces)), sizes)[: len(place)]
    valid = np.flatnonzero(np.arange(len(place)) + length <= (base + sizes)[owner])
    where = place[valid]
    cut = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (valid[1:] != valid[:-1] + 1)]))
    first, n = valid[cut], np.diff(np.concatenate([cut, [len(valid)]]))
    a, u = g[where[cut]], names_at(n81, first, length - 1 + n)
    _, head, group, count = np.unique(u, return_index=True, return_inverse=True, return_counts=True)
    row = np.array([i for i, _, _ in pieces], np.int64)[owner[first]]
    p = first - base[owner[first]] + np.array([o for _, o, _ in pieces], np.int64)[owner[first]]
    many = np.flatnonzero(count[group] > 1)
    cover = {"row": [], "p": [], "n": []}
    many = many[np.argsort(row[many], kind="stable")]  # the rows of a batch come in any order
    for own in np.split(many, np.flatnonzero(np.diff(row[many])) + 1) if len(many) else ():
        s, e = merged(p[own], p[own] + n[own] + length - 1)
        cover["row"].append(np.full(len(s), row[own[0]]))
        cover["p"].append(s)
        cover["n"].append(e - s)
    zero = [np.zeros(0, np.int64)]
    extra = {k: np.concatenate(v or zero) for k, v in cover.items()}
    none = np.zeros(len(extra["row"]), np.int64)
    return {
        "row": np.concatenate([row[head], extra["row"]]), "p": np.concatenate([p[head], extra["p"]]), "n": np.concatenate([n[head], extra["n"]]),
        "a": np.concatenate([a.view(np.int64)[head], none]), "u": np.concatenate([u.view(np.int64)[head], none]), "c": np.concatenate([count, none]),
    }


_RUN_FIELDS = ("row", "p", "n", "a", "u", "c")


def _runs(table: DataFrame, length: int, gram: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pieces in _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist(), length):
                got = runs(pieces, length, gram)
                yield pa.RecordBatch.from_arrays([pa.array(got[f], pa.int64()) for f in _RUN_FIELDS], list(_RUN_FIELDS))

    return table.select("row", "text").mapInArrow(work, ", ".join(f"`{f}` long" for f in _RUN_FIELDS))


def _strings(texts: DataFrame, length: int) -> DataFrame:
    """a, part, row, p, whole, at, names: the packed names of the strings of each wanted run; input row, text, wanted (p, n, a, whole, parts).

    ``at`` holds the offsets from p (null: 0, 1, 2 ...). The strings of a much-repeated sample are dealt into parts by their
    names. Of strings that are equal within a batch only the first goes on; what they cover comes out at once, as rows without a
    name (p, and its length in ``part``).
    """
    kinds = {"a": pa.int64(), "part": pa.int64(), "row": pa.int64(), "p": pa.int64(), "whole": pa.bool_(), "at": pa.binary(), "names": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for row, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                wanted.sort(key=lambda w: w["p"])
                raw, at, n81 = np.frombuffer(text.as_buffer(), np.uint8), -1, None
                for w in wanted:
                    if n81 is None or w["p"] + w["n"] + length - 1 > at + PIECE + 2 * length:
                        at = w["p"]
                        n81 = names_81(raw[at : at + PIECE + 2 * length])
                    found.append((w["a"], row, w["p"], w["whole"], w["parts"], names_at(n81, w["p"] - at + np.arange(w["n"]), length)))
            out: dict[str, list] = {f: [] for f in kinds}
            if found:
                every = np.concatenate([f[5] for f in found])
                order = np.argsort(every, kind="stable")
                same = every[order][1:] == every[order][:-1]
                again, hit = np.zeros(len(every), bool), np.zeros(len(every), bool)
                again[order[1:][same]] = True  # not the first of its equals
                hit[order[1:][same]] = hit[order[:-1][same]] = True
                base = 0
                for a, row, p, whole, parts, names in found:
                    mine = slice(base, base + len(names))
                    base += len(names)
                    if not whole and hit[mine].any():
                        own = np.flatnonzero(hit[mine])
                        for s, e in zip(*(x.tolist() for x in merged(p + own, p + own + length))):
                            for f, v in zip(kinds, (a, e - s, row, s, False, None, None)):
                                out[f].append(v)
                    kept = np.flatnonzero(~again[mine])
                    share = (names[kept] >> np.uint64(40)) % np.uint64(parts) if parts > 1 else np.zeros(len(kept), np.uint64)
                    for part in np.unique(share):
                        at = kept[share == part]
                        packed = None if len(at) == len(names) else at.astype(np.uint16).tobytes()
                        for f, v in zip(kinds, (a, int(part), row, p, whole, packed, names[at].tobytes())):
                            out[f].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[f], k) for f, k in kinds.items()], list(kinds))

    return texts.mapInArrow(work, "a long, part long, `row` long, p long, whole boolean, `at` binary, names binary")


def _repeated(strings: DataFrame, length: int) -> DataFrame:
    """row, p, n: what the repeated strings cover in the runs that are not repeated as a whole; rows come sorted by sampled name and part."""

    def groups(batches):
        key, held = None, []
        for batch in batches:
            for a, part, row, p, whole, at, names in zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5), batch.column(6)):
                if not names.is_valid:
                    yield [(row, p, part)]
                    continue
                if key != (a, part) and held:
                    yield held
                    held = []
                key = (a, part)
                names = np.frombuffer(names.as_buffer(), np.uint64)
                held.append((row, p, whole, np.frombuffer(at.as_buffer(), np.uint16) if at.is_valid else np.arange(len(names)), names))
        if held:
            yield held

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[int]] = [[], [], []]

        def flush():
            got = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["row", "p", "n"])
            for x in out:
                x.clear()
            return got

        for group in groups(batches):
            if len(group[0]) == 3:  # found inside a batch
                for x, v in zip(out, group[0]):
                    x.append(v)
            else:
                every = np.concatenate([g[4] for g in group])
                order = np.argsort(every, kind="stable")
                same = every[order][1:] == every[order][:-1]  # adjacent strings
                hit = np.zeros(len(every), bool)
                hit[order[1:][same]] = hit[order[:-1][same]] = True
                base = 0
                for row, p, whole, at, names in group:
                    own = p + at[hit[base : base + len(names)]].astype(np.int64)
                    base += len(names)
                    if not whole and len(own):
                        s, e = merged(own, own + length)
                        out[0] += [row] * len(s)
                        out[1] += s.tolist()
                        out[2] += (e - s).tolist()
            if len(out[0]) > 5000:
                yield flush()
        yield flush()

    return strings.mapInArrow(work, "`row` long, p long, n long")


def _finish(joined: DataFrame, kind: str) -> DataFrame:
    """The result from doc_id, text and the intervals (p, n) of a text, null for none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, cover in zip(batch.column(1), batch.column(2)):
                raw = text.as_buffer().to_pybytes()
                if not cover.is_valid:
                    out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), ""))
                    continue
                p = np.asarray(cover.values.field("p"), np.int64)
                s, e = merged(p, p + np.asarray(cover.values.field("n"), np.int64))
                h = hashlib.sha256()
                for a, b in zip([0, *e.tolist()], [*s.tolist(), len(raw)]):
                    h.update(raw[a:b])
                out.append((len(raw), int((e - s).sum()), len(s), h.hexdigest(), ",".join(f"{a}:{b}" for a, b in zip(s.tolist(), e.tolist()))))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return joined.mapInArrow(work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed string")


def _bucketed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """row, doc_id, text (bytes), written bucketed by row, each row with a number of its own; and whether the buckets are as small as they should be.

    There are no more buckets than the session allows (spark.sql.sources.bucketing.maxBuckets); beyond that they grow with the texts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length(docs["text"].cast("string")))).first()[0] or 0
    # with fewer buckets than shuffle partitions the planner would shuffle the texts after all
    n = max(4, -(-total // BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = min(n, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    if n * rows.rdd.getNumPartitions() > MOST_FILES:  # else every task writes its own file of each bucket, and nothing is shuffled
        rows = rows.repartition(n, "row")
    name = "texts_" + scratch_path(spark, "").rpartition("-")[2]
    rows.write.format("parquet").bucketBy(n, "row").option("path", scratch_path(spark, "op2")).saveAsTable(name)
    return spark.table(name), n * BUCKET_BYTES >= total


def remove_repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (start:end in bytes, joined by commas) of every document."""
    if not 81 <= gram <= min(162, length - 1) or not 243 <= length <= 486:
        raise ValueError("lengths outside the range of the names")
    small_batches(docs.sparkSession)
    table, small = _bucketed(docs)
    # what is known of the texts of a bucket is held in memory beside it; of larger buckets it is sorted, which spills
    method = "shuffle_hash" if small else "merge"
    found = _runs(table, length, gram)
    by_sample, by_run = Window.partitionBy("a"), Window.partitionBy("a", "u")
    # intervals found inside a batch (c = 0) need no partner; they go along spread by row
    found = found.withColumn("a", F.when(F.col("c") == 0, F.xxhash64("row")).otherwise(F.col("a")))
    able = found.withColumn("samples", F.sum("c").over(by_sample)).filter("samples > 1 or c = 0")
    able = able.withColumn("times", F.sum("c").over(by_run)).withColumn("head", F.min(F.when(F.col("c") > 0, F.struct("row", "p"))).over(by_run))
    whole = F.col("times") > 1
    able = able.select(
        "row", "p", "n", "a", F.ceil(F.col("samples") / PART_RUNS).alias("parts"), whole.alias("whole"), (F.col("c") == 0).alias("inside"),
        ((F.col("c") > 0) & (~whole | (F.struct("row", "p") == F.col("head")))).alias("sorted"), (whole & (F.col("c") == 1)).alias("covered"),
    )
    able = checkpoint(able.filter("inside or sorted or covered"))
    wanted = able.filter("sorted").groupBy("row").agg(F.collect_list(F.struct("p", "n", "a", "whole", "parts")).alias("wanted"))
    texts = table.join(wanted.hint(method), "row").select("row", "text", "wanted")
    strings = _strings(texts, length)
    strings = strings.repartition(F.col("a"), F.col("part")).sortWithinPartitions("a", "part")
    single = _repeated(strings, length)
    cover = able.filter("inside").select("row", "p", "n").unionByName(able.filter("covered").select("row", "p", (F.col("n") + length - 1).alias("n"))).unionByName(single)
    cover = checkpoint(cover.groupBy("row").agg(F.collect_list(F.struct("p", "n")).alias("cover")))
    joined = table.join(cover.hint(method), "row", "left").select("doc_id", "text", "cover")
    return _finish(joined, dict(docs.dtypes)["doc_id"])


#: Every string of the texts, in hexadecimal, by its digest.
ORACLE = f"""
WITH h AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, h, unnest(range(0, greatest(len(h) // 2 - {LENGTH - 1}, 0))) AS i FROM h),
m AS (SELECT r, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), {2 * LENGTH})) AS m FROM p),
again AS (SELECT m FROM m GROUP BY m HAVING count(*) > 1),
rep AS (SELECT r, i FROM m SEMI JOIN again USING (m)),
cuts AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {LENGTH} THEN 0 ELSE 1 END AS cut FROM rep),
isles AS (SELECT r, i, sum(cut) OVER (PARTITION BY r ORDER BY i) AS g FROM cuts),
spans AS (SELECT r, min(i) AS s, max(i) + {LENGTH} AS e FROM isles GROUP BY r, g),
gaps AS (SELECT h.r, coalesce(lag(e) OVER (PARTITION BY h.r ORDER BY s), 0) AS a, s AS b FROM h JOIN spans ON spans.r = h.r
  UNION ALL SELECT h.r, coalesce(max(e), 0), len(any_value(h)) // 2 FROM h LEFT JOIN spans ON spans.r = h.r GROUP BY h.r),
kept AS (SELECT r, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS k FROM gaps JOIN h USING (r) GROUP BY r),
sums AS (SELECT r, count(*) AS n, sum(e - s) AS gone FROM spans GROUP BY r)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM h JOIN kept USING (r) LEFT JOIN sums USING (r)
"""
