"""Phrase collocations: an FM-index over word ids for each shard, extended on both sides, counts summed across shards.

A text is lower-cased (A-Z only), split into pieces at ``[.,;:!?\\n\\x0B\\x0C\\r]`` and pieces into words at spaces and tabs; everything is counted within
a language (null: ``und``). A task turns its texts into shards of at most ``SHARD_WORDS`` word ids; some shards of a task share a book, the table of their distinct words.

Level by level, each shard tells the counts of the phrases it holds and shuffles sum them. Most phrases of a level turn out to be rare, so shards first send counts by cell, a hash of the
phrase: three bytes for each instead of a row. Cells under ``least`` hold no phrase that reaches it, and the shards hear, one bit for each, which cells go on; rows are made for the
phrases of these only. A window over equal phrases then gives the exact total and one common number to every shard that has the phrase. Phrases under ``least`` are gone, and only phrases whose first and last k words are both left are looked
at with k+1 words (any part of a frequent phrase is as frequent). A phrase of k+1 words is named by the numbers of these two parts, so rows stay
five numbers wide at any length.

Within a shard, a phrase is a pair of intervals, in the suffix order of the word ids and in that of the reversed ids (both by the first ``DEPTH``
words, which is all that intervals of such phrases need). Even lengths are reached by a step to the left in the Burrows-Wheeler transform of the ids,
odd ones by a step to the right in that of the reversed ids: the words next to an interval, counted, are its extensions; ranks give the
interval in the same order, the counts of smaller words the one in the other order. All intervals of a shard step together, ``STEP_WORDS`` words at a time.

A shard that ends inside a piece hands its last words to the next one as context; phrases wholly within that context are counted once only. So neither
the length of a text nor of a piece bounds what is counted, and memory follows ``SHARD_WORDS``. Words under ``least`` cut pieces like punctuation.

Defined cases: null or empty texts and the empty table have no words; repeated rows count as often as they occur; other columns are not read; ties go as
the contract says (score, count, phrase in UTF-8 order). No lang or word is held by one task alone: a group is a phrase's rows, one for each shard.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path, small_batches

DEPTH, LEAST, TOP = 5, 100, 2000
#: Words of a shard; a number below 2**24. What moves as one value (the ids, each index) then fits into ``BATCH_BYTES``.
SHARD_WORDS = 1_000_000
#: A book is closed when it has a word for so many words of a shard.
BOOK_SHARE = 4
#: Bytes of a text that are split into words at a time.
BLOCK = 1 << 22
#: Words of the intervals that are extended at a time (one interval at least).
STEP_WORDS = 1 << 18
#: Bytes of the shards that Python gets at a time (one shard at least), and the setting that bounds them.
BATCH_BYTES, BATCH_KEY = 1 << 22, "spark.sql.execution.arrow.maxBytesPerBatch"
#: Cells of one part of the hash of a level, and words of the corpus for each part (there are as many parts as shuffle partitions at least).
CELLS, PART_WORDS = 1 << 20, 1 << 22
#: The most buckets that Spark lets a table have.
MOST_BUCKETS = 100_000

#: Capitals and separators of the contract.
CAPITALS, SMALL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
CUTS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A byte that no UTF-8 text holds stands for the end of a piece.
CUT = b"\xff"
_PLAIN = bytes.maketrans(CAPITALS + b"\x09" + CUTS, SMALL + b" " + CUT * len(CUTS))

SHARD_SCHEMA = "book long, shard long, codes binary, head int, lang string, id int, word binary, n long"
LEVEL_SCHEMA = "shard long, at long, prefix long, suffix long, n long"


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in blocks, ``CUT`` where a piece ends."""
    data = text.translate(_PLAIN)
    start = 0
    while start < len(data):
        end = start + BLOCK
        if end < len(data):  # not within a word
            ends = [e for e in (data.find(b" ", end), data.find(CUT, end)) if e >= 0]
            end = min(ends) if ends else len(data)
        yield data[start:end].replace(CUT, b" \xff ").split()
        start = end


class _Ids(dict):
    """Numbers of the words of one language; those of a book run over all its languages."""

    def __init__(self, book: _Book):
        super().__init__({CUT: 0})
        self.book = book

    def __missing__(self, word: bytes) -> int:
        self.book.size += 1
        self[word] = self.book.size
        return self.book.size


class _Book:
    """The distinct words of shards of one task, and how often they occur."""

    def __init__(self, number: int):
        self.number, self.size, self.langs, self.n = number, 0, {}, np.zeros(1, np.int64)

    def ids(self, lang: str) -> _Ids:
        if lang not in self.langs:
            self.langs[lang] = _Ids(self)
        return self.langs[lang]

    def shard(self, number: int, codes: array, head: int) -> pa.RecordBatch:
        """The row of a shard, whose words are counted; the first ``head`` words are context of the shard before."""
        codes.append(0)  # 0 is the end of a piece
        ids = np.frombuffer(codes, np.int32).astype("<i4", copy=False)
        n = np.bincount(ids, minlength=self.size + 1) - np.bincount(ids[1 : 1 + head], minlength=self.size + 1)
        n[: len(self.n)] += self.n
        self.n = n
        return _rows(self.number, [number], [ids.tobytes()], [head], [None], [None], [None], [None])

    def rows(self, some: int = 100_000) -> Iterator[pa.RecordBatch]:
        """The rows of the words."""
        words = ((lang, i, word) for lang, table in self.langs.items() for word, i in table.items() if i)
        while part := list(islice(words, some)):
            langs, ids, own = zip(*part)
            empty = [None] * len(ids)
            yield _rows(self.number, empty, empty, empty, langs, ids, own, self.n[np.array(ids)])


def _rows(book: int, *values) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.int64()]
    cols = [pa.array(x, kind) for x, kind in zip([[book] * len(values[0]), *values], kinds)]
    return pa.RecordBatch.from_arrays(cols, ["book", "shard", "codes", "head", "lang", "id", "word", "n"])


def _gather(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    made = TaskContext.get().partitionId() << 15
    book, codes, head = _Book(made), array("i", [0]), 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, text = lang.as_py(), text.as_py()
            past: list[bytes] = []
            for words in pieces(text):
                for i in range(0, len(words), most):
                    some = words[i : i + most]
                    if len(codes) + len(some) > most and len(codes) > 1 + head:
                        yield book.shard(made, codes, head)
                        made += 1
                        if book.size >= most // BOOK_SHARE:
                            yield from book.rows()
                            book = _Book(made)
                        codes, head = array("i", [0, *map(book.ids(lang).__getitem__, past)]), len(past)
                    codes.extend(map(book.ids(lang).__getitem__, some))
                    past = (past + some[1 - DEPTH :])[1 - DEPTH :]
                    past = past[len(past) - past[::-1].index(CUT) :] if CUT in past else past
            codes.append(0)
    if book.size:
        yield book.shard(made, codes, head)
        yield from book.rows()


# The index of a shard


def suffix_order(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Positions ordered by their first ``depth`` symbols (round the end): from the last symbol to the first, 16 bits at a time, which numpy sorts by counting."""
    halves = [symbols.astype(np.uint16)]
    if int(symbols.max()) >> 16:
        halves.append((symbols >> 16).astype(np.uint16))
    order = np.arange(len(symbols), dtype=np.int32)
    for i in reversed(range(depth)):
        for half in halves:
            order = order[np.argsort(np.roll(half, -i)[order], kind="stable")]
    return order


def transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the symbol before each suffix in order, the order)."""
    order = suffix_order(symbols)
    return symbols[order - 1], order


def steps(bwt: np.ndarray, near: np.ndarray, far: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """One extension of all intervals, some at a time: (the interval each comes from, near, far, size) of those by a word."""
    n = len(bwt)
    order = np.argsort(bwt, kind="stable")
    ranks = bwt[order].astype(np.int64)  # where each symbol stands, by symbol: what a rank counts
    ranks *= n
    ranks += order
    del order
    ends = np.cumsum(size)
    span = int(bwt.max(initial=0)) + 1
    start = 0
    while start < len(near):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + STEP_WORDS, "right")))
        own = size[start:stop]
        begin = np.cumsum(own) - own
        at = np.arange(begin[-1] + own[-1]) + np.repeat(near[start:stop] - begin, own)
        pairs = np.sort(np.repeat(np.arange(stop - start, dtype=np.int64), own) * span + bwt[at])
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        count = np.diff(first, append=len(pairs))
        owner, symbol = np.divmod(pairs[first], span)
        smaller = first - begin[owner]
        word = symbol > 0
        owner, symbol, count, smaller = owner[word] + start, symbol[word], count[word], smaller[word]
        yield owner, np.searchsorted(ranks, symbol * n + near[owner]), far[owner] + smaller, count
        start = stop


def _joined(parts: list[tuple[np.ndarray, ...]], width: int) -> tuple[np.ndarray, ...]:
    return tuple(map(np.concatenate, zip(*parts))) if parts else (np.zeros(0, np.int64),) * width


def step(bwt: np.ndarray, near: np.ndarray, far: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """All of ``steps`` at once."""
    return _joined(list(steps(bwt, near, far, size)), 4)


def within(starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The interval (ordered, apart from one another) that holds each position, or -1."""
    i = np.searchsorted(starts, at, "right") - 1
    return np.where((i >= 0) & (at < starts[i] + sizes[i]), i, -1) if len(starts) else np.full(len(at), -1)


def _longer(bwt: np.ndarray, left: bool, length: int, lo: np.ndarray, back: np.ndarray, size: np.ndarray, number: np.ndarray, head: np.ndarray) -> dict[str, np.ndarray]:
    """The phrases of length + 1 words whose parts of ``length`` words are both among the given ones: at, prefix, suffix, n."""
    near, far = (lo, back) if left else (back, lo)
    by = np.argsort(near)
    near, far, size, number = near[by], far[by], size[by], number[by]
    some = []
    for found in steps(bwt, near, far, size):
        part = within(near, size, found[1])
        some.append(tuple(x[part >= 0] for x in (*found, part)))
    owner, new, other, count, part = _joined(some, 5)
    del some
    first, last = (part, owner) if left else (owner, part)
    lo, back = (new, other) if left else (other, new)
    by = np.argsort(lo)
    lo, back, count, first, last = lo[by], back[by], count[by], first[by], last[by]
    spare = np.zeros(len(lo), np.int64)
    again = within(lo, count, head[: max(len(head) - length, 0)])  # phrases within the context were counted by the shard before
    np.add.at(spare, again[again >= 0], 1)
    return {"at": lo << 32 | back << 8 | spare, "prefix": number[first], "suffix": number[last], "n": count - spare}


def _pack(symbols: np.ndarray) -> bytes:
    return symbols.astype("<u2" if symbols.max(initial=0) < 1 << 16 else "<u4").tobytes()


def _symbols(data: bytes, words: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * words else "<u4")


def _unpack(data: bytes, words: int) -> np.ndarray:
    return _symbols(data, words).astype(np.int64)


def _longs(known: pa.Scalar, *names: str) -> list[np.ndarray]:
    return [known.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names]


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index of each shard over the words that are left, and these as phrases of one word."""
    for batch in batches:
        for shard, codes, context, known in zip(*batch.columns):
            codes = np.frombuffer(codes.as_py(), "<i4")
            ids, number = _longs(known, "id", "number")
            held = np.zeros(1 + max(codes.max(initial=0), ids.max(initial=0)), bool)
            held[codes] = True
            ids, number = ids[held[ids]], number[held[ids]]
            if not len(ids):
                continue
            by = np.argsort(ids)
            ids, number = ids[by], number[by]
            place = np.zeros(int(codes.max(initial=0)) + 1, np.int32)
            place[ids] = np.arange(1, len(ids) + 1)
            symbols = place[codes]
            kept = np.concatenate([[True], (symbols[1:] > 0) | (symbols[:-1] > 0)])  # one cut is as good as many
            head = int(np.count_nonzero(kept[1 : 1 + context.as_py()]))
            symbols = symbols[kept]
            before, order = transform(symbols)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            context_ranks = rank[1 : 1 + head].copy()
            del order, rank
            after, _ = transform(symbols[::-1])
            size = np.bincount(symbols, minlength=len(ids) + 1)
            lo = (np.cumsum(size) - size)[1:]
            phrases = pa.StructArray.from_arrays([pa.array(lo << 32 | lo << 8, pa.int64()), pa.array(size[1:], pa.int64()), pa.array(number, pa.int64())], ["at", "n", "number"])
            phrases = pa.ListArray.from_arrays(pa.array([0, len(phrases)], pa.int32()), phrases)
            cols = [pa.array([shard.as_py()], pa.int64()), pa.array([len(symbols)], pa.int64()), pa.array([_pack(before)], pa.binary()), pa.array([_pack(after)], pa.binary())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([context_ranks], pa.list_(pa.int64())), phrases], ["shard", "words", "left", "right", "head", "known"])


def _found(left: bool, length: int, words: pa.Scalar, bwt: pa.Scalar, head: pa.Scalar, known: pa.Scalar) -> dict[str, np.ndarray]:
    at, n, number = _longs(known, "at", "n", "number")
    return _longer(_symbols(bwt.as_py(), words.as_py()), left, length, at >> 32, at >> 8 & 0xFFFFFF, n + (at & 0xFF), number, np.array(head.as_py(), np.int64))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _cells(found: dict[str, np.ndarray], parts: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct cells in order, where each part of them begins, the cell of each phrase): a cell is part * width + place."""
    h = found["prefix"].astype(np.uint64)
    for more in (found["suffix"].astype(np.uint64), np.uint64(0)):
        h = (h * _MIX) + more
        h ^= h >> np.uint64(29)
    part, place = h % np.uint64(parts), (h // np.uint64(parts)) % np.uint64(width)
    cells, own = np.unique((part * np.uint64(width) + place).astype(np.int64), return_inverse=True)
    return cells, np.searchsorted(cells, np.arange(parts + 1) * width), own


def _ask(left: bool, length: int, parts: int, width: int, least: int):
    """Function for mapInArrow: the counts of each shard by cell, a row for each part: steps between the cells, and counts up to ``least``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, *index in zip(*batch.columns):
                found = _found(left, length, *index)
                cells, ends, own = _cells(found, parts, width)
                n = np.bincount(own, weights=found["n"], minlength=len(cells)).clip(0, least).astype("<u1" if least < 256 else "<u4")
                held = np.flatnonzero(np.diff(ends))
                gaps = [np.diff(cells[ends[p] : ends[p + 1]] - p * width, prepend=0) for p in held]
                steps = [_pack(g) for g in gaps]
                counts = [n[ends[p] : ends[p + 1]].tobytes() for p in held]
                cols = [pa.array(held, pa.int32()), pa.array([shard.as_py()] * len(held), pa.int64()), pa.array([len(g) for g in gaps], pa.int32()), pa.array(steps, pa.binary()), pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["part", "shard", "size", "steps", "counts"])

    return work


def _answer(width: int, least: int):
    """Function for applyInArrow: one part of the cells; for each shard, a bit for each of its cells that says whether all shards together reach ``least`` there."""

    def work(rows: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        cells = [np.cumsum(_unpack(x.as_py(), n.as_py())) for x, n in zip(rows.column("steps"), rows.column("size"))]
        for own, n in zip(cells, rows.column("counts")):
            total[own] += np.frombuffer(n.as_py(), "<u1" if least < 256 else "<u4")
        bits = [np.packbits(total[own] >= least).tobytes() for own in cells]
        return pa.table([rows.column("shard"), rows.column("part"), pa.array(bits, pa.binary())], names=["shard", "part", "bits"])

    return work


def _extend(left: bool, length: int, parts: int, width: int):
    """Function for mapInArrow: index rows with the phrases of ``length`` words that are left and the answer of the cells, to phrases of one word more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, *index, answer in zip(*batch.columns):
                found = _found(left, length, *index)
                cells, ends, own = _cells(found, parts, width)
                alive = np.zeros(len(cells), bool)
                for p, bits in zip(answer.values.field("part").to_pylist(), answer.values.field("bits").to_pylist()):
                    alive[ends[p] : ends[p + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=ends[p + 1] - ends[p])
                chosen = np.flatnonzero(alive[own])
                for start in range(0, len(chosen), 100_000):
                    some = chosen[start : start + 100_000]
                    cols = [pa.array(np.full(len(some), shard.as_py()), pa.int64()), *(pa.array(found[c][some], pa.int64()) for c in ("at", "prefix", "suffix", "n"))]
                    yield pa.RecordBatch.from_arrays(cols, ["shard", "at", "prefix", "suffix", "n"])

    return work


# The levels


def _table(rows: DataFrame, name: str, by: str = "shard") -> DataFrame:
    """Written bucketed by shard (or book), as many buckets as shuffle partitions, so that joins by it move the other side only."""
    spark = rows.sparkSession
    n = min(MOST_BUCKETS, max(4, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows.write.format("parquet").bucketBy(n, by).saveAsTable(name)
    return spark.table(name)


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _frequent(rows: DataFrame, keys: list[str], own, least: int) -> DataFrame:
    """The rows of phrases that all shards together hold ``least`` times: with ``total``, and ``number``, the same for all rows of a phrase."""
    same = Window.partitionBy(*keys)
    return rows.withColumn("total", F.sum("n").over(same)).withColumn("number", F.min(own).over(same)).filter(F.col("total") >= least)


def _with_known(index: DataFrame, kept: DataFrame, *columns: str, name: str = "known", by: str = "shard") -> DataFrame:
    known = kept.groupBy(by).agg(F.collect_list(F.struct(*columns)).alias(name))
    return index.join(known.hint("shuffle_hash"), by)


def phrases(docs: DataFrame, least: int = LEAST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, phrase, words, count, n (words of the lang), firsts and lasts (counts of its first and last 1, 2, ... words), longest (the most that one
    more word on either side occurs with it, null if less than ``least`` or if the phrase has ``DEPTH`` words), of all phrases of 1 to ``DEPTH`` words that occur ``least`` times.
    """
    if not 64 <= shard_words < 1 << 23 or least < 1:
        raise ValueError("shard_words or least out of range")
    spark = docs.sparkSession
    small_batches(spark)
    path = scratch_path(spark, "op11")
    shards, index = (f"op11_{what}_" + path.rpartition("-")[2] for what in ("shards", "index"))
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"))
    batch_bytes = spark.conf.get(BATCH_KEY, None)
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        gathered = _table(texts.mapInArrow(lambda batches: _gather(batches, shard_words), SHARD_SCHEMA), shards, "book")
        counted = gathered.filter("word is not null").select("book", "lang", "id", "word", "n")
        own = F.shiftleft("book", 24).bitwiseOR(F.col("id").cast("long"))
        kept = _kept(_frequent(counted, ["lang", "word"], own, least), f"{path}/1")
        sums = counted.groupBy("lang").agg(F.sum("n").alias("all"))
        one = kept.filter(F.col("number") == own).join(sums, "lang")
        word = F.col("word").cast("string")
        level = one.select("number", "lang", word.alias("phrase"), word.alias("last"), F.col("total").alias("a"), F.col("all").alias("n"), F.array("total").alias("firsts"), F.array("total").alias("lasts"))
        levels = [_kept(level, f"{path}/phrases1")]
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(sums.agg(F.sum("all")).first()[0] or 0) // PART_WORDS))
        built = _with_known(gathered.filter("codes is not null").select("book", "shard", "codes", "head"), kept, "id", "number", by="book").select("shard", "codes", "head", "known")
        table = _table(built.mapInArrow(_build, "shard long, words long, left binary, right binary, head array<long>, known array<struct<at: long, n: long, number: long>>"), index)
        spark.sql(f"DROP TABLE IF EXISTS {shards}")  # nothing reads it from here on
        own = F.shiftleft("shard", 24).bitwiseOR(F.shiftright("at", 32))
        for length in range(1, DEPTH):
            left = length % 2 == 1
            column = "left" if left else "right"
            ready = table if length == 1 else _with_known(table.drop("known"), kept, "at", "n", "number")
            ready = ready.select("shard", "words", column, "head", "known")
            asked = ready.mapInArrow(_ask(left, length, parts, CELLS, least), "part int, shard long, size int, steps binary, counts binary")
            answer = asked.groupBy("part").applyInArrow(_answer(CELLS, least), "shard long, part int, bits binary")
            found = _with_known(ready, answer, "part", "bits", name="answer").mapInArrow(_extend(left, length, parts, CELLS), LEVEL_SCHEMA)
            kept = _kept(_frequent(found, ["prefix", "suffix"], own, least), f"{path}/{length + 1}")
            p, s = (levels[-1].select(*(F.col(c).alias(f"{side}_{c}") for c in cols)) for side, cols in (("p", ["number", "lang", "phrase", "n", "firsts"]), ("s", ["number", "last", "lasts"])))
            level = kept.filter(F.col("number") == own).select("number", "prefix", "suffix", "total")
            level = level.join(p, F.col("prefix") == F.col("p_number")).join(s, F.col("suffix") == F.col("s_number"))
            grown = lambda c: F.concat(c, F.array("total"))
            level = level.select("number", F.col("p_lang").alias("lang"), F.concat_ws(" ", "p_phrase", "s_last").alias("phrase"), F.col("s_last").alias("last"), F.col("total").alias("a"), F.col("p_n").alias("n"),
                                 grown("p_firsts").alias("firsts"), grown("s_lasts").alias("lasts"), "prefix", "suffix")
            levels.append(_kept(level, f"{path}/phrases{length + 1}"))
    finally:
        spark.conf.unset(BATCH_KEY) if batch_bytes is None else spark.conf.set(BATCH_KEY, batch_bytes)
        for name in (shards, index):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    out = None
    for k, level in enumerate(levels):
        if k + 1 < DEPTH:
            more = levels[k + 1]
            more = more.select(F.col("prefix").alias("number"), "a").unionByName(more.select(F.col("suffix").alias("number"), "a")).groupBy("number").agg(F.max("a").alias("longest"))
            level = level.join(more, "number", "left")
        else:
            level = level.withColumn("longest", F.lit(None).cast("long"))
        level = level.select("lang", "phrase", F.lit(k + 1).alias("words"), F.col("a").alias("count"), "n", "firsts", "lasts", "longest")
        out = level if out is None else out.unionByName(level)
    return out


def scored(found: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of phrases of two words or more: the cut with the lowest floor(1000 a n / (l r)), the first of equal ones."""
    exact = lambda c: c.cast("decimal(19,0)")
    a, n = exact(F.col("count")), exact(F.col("n"))

    def cut(k):
        l, r = F.element_at("firsts", k), F.element_at("lasts", F.col("words") - k)  # noqa: E741
        return F.struct(F.call_function("div", a * n * F.lit(1000).cast("decimal(5,0)"), exact(l) * exact(r)).alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    best = found.filter("words > 1").withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), F.col("words") - 1), cut)))
    return best.select("lang", "phrase", F.col("count").alias("a"), "cut.l", "cut.r", "n", "cut.score", "longest")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` of each lang, without phrases that only occur inside a longer one."""
    rows = scored(phrases(docs, least, shard_words)).filter("longest is null or 100 * longest < 100 * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: Every occurrence of up to five words as a row, by lead() within its piece.
ORACLE = f"""
WITH pieces AS (SELECT row_number() OVER () AS piece, lang, p FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{CAPITALS.decode()}', '{SMALL.decode()}'), '[.,;:!?\n\x0B\x0C\r]')) AS p FROM documents)),
words AS (SELECT piece, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT piece, lang, regexp_extract_all(p, '[^ \t]+') AS ws FROM pieces)),
runs AS (SELECT lang, w AS w1, {", ".join(f"lead(w, {k}) OVER (PARTITION BY piece ORDER BY i) AS w{k + 1}" for k in range(1, DEPTH))} FROM words),
f AS ({" UNION ALL ".join(f"SELECT lang, [{', '.join(f'w{j}' for j in range(1, k + 1))}] AS ws, {k} AS k, count(*) AS a FROM runs WHERE w{k} IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}" for k in range(1, DEPTH + 1))}),
n AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
longer AS (SELECT lang, ws[2:] AS ws, max(a) AS a FROM f WHERE k > 2 GROUP BY ALL UNION ALL SELECT lang, ws[:-2] AS ws, max(a) AS a FROM f WHERE k > 2 GROUP BY ALL),
c AS (SELECT f.* FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM longer WHERE longer.lang = f.lang AND longer.ws = f.ws AND longer.a >= f.a)),
cuts AS (SELECT c.lang, c.ws, c.a, unnest(range(1, c.k)) AS j, c.k FROM c),
s AS (SELECT cuts.lang, cuts.ws, cuts.a, j, x.a AS l, y.a AS r, n.n, CAST(1000 * CAST(cuts.a AS HUGEINT) * n.n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.ws = cuts.ws[:j] JOIN f y ON y.lang = cuts.lang AND y.ws = cuts.ws[j + 1:] JOIN n ON n.lang = cuts.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank, array_to_string(ws, ' ') AS phrase, a, l, r, n, score
FROM best QUALIFY rank <= {TOP}
"""
