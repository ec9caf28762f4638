"""SentencePiece encoding and decoding by a table of distinct chunks.

In the models served here no piece holds a white-space mark after another character, so merges
never cross the place where a mark follows a word. Nor does a character that occurs in no longer
piece ever merge with its neighbours. A text is cut at both kinds of places into marked words; each
distinct marked word is segmented once and its ids (and their decoding) are joined back by position.

The table is kept by each Python worker and bounded by ``TABLE_ENTRIES``: a full table is emptied, and
chunks longer than ``LONGEST_KEPT`` are never kept, so memory does not follow the vocabulary of the corpus.
Nothing is shuffled: the work of a task is its own partition.

Defined results: null text counts as empty; the empty text has no ids and decodes to the empty text;
very long texts are one run over their chunks; repeated rows give repeated rows; an empty table gives
an empty table; further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

MARK = "▁"
TABLE_ENTRIES = 150_000
LONGEST_KEPT = 64


class ChunkTable:
    """Distinct marked words of a model's texts: their ids, written out with commas, and their decoded text."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp = self.sp
        pieces = [
            sp.id_to_piece(i)
            for i in range(sp.get_piece_size())
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        ]
        longer = [p for p in pieces if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("the model has pieces that cross a white-space mark")
        merging = {c for p in longer for c in p} - {MARK}
        if "\n" in merging or sp.encode("\n")[:1] != sp.encode("\nx")[:1] or len(sp.encode("\n")) != 2:
            raise ValueError("the model needs a line feed that stands alone and a mark before the text")
        kept = "".join(sorted(map(re.escape, merging)))
        self.cut = re.compile(f"{MARK}*[{kept}]+|{MARK}+|[^{MARK}]")
        self.alone = sp.piece_to_id(MARK)
        self.lead = sp.piece_to_id("a")
        self.say = list(map(str, range(sp.get_piece_size())))
        self.csv: dict[str, str] = {}
        self.plain: dict[str, str] = {}
        self.long: list[str] = []

    def chunks(self, text: str) -> list[str]:
        """Marked words of a text; a mark is put before it, as the model does."""
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, found: list[list[str]]) -> None:
        """Segment the marked words that the table lacks, each distinct one once."""
        csv, plain = self.csv, self.plain
        if len(csv) > TABLE_ENTRIES:
            csv.clear()
            plain.clear()
        for c in self.long:
            csv.pop(c, None)
            plain.pop(c, None)
        new = [c for c in set().union(*found) if c not in csv]
        self.long = [c for c in new if len(c) > LONGEST_KEPT]
        marked, bare = [c for c in new if c[0] == MARK and c != MARK], [c for c in new if c[0] != MARK]
        ids = self.sp.encode([c[1:] for c in marked], num_threads=1) if marked else []
        if bare:
            ids += [i[2:] for i in self.sp.encode(["\n" + c for c in bare], num_threads=1)]  # behind a lone mark and a line feed
        known = marked + bare
        if MARK in new:
            known.append(MARK)
            ids.append([self.alone])
        say = self.say
        csv.update(zip(known, [",".join([say[i] for i in own]) for own in ids]))
        plain.update(zip(known, self._decode(ids)))

    def _decode(self, runs: list[list[int]]) -> list[str]:
        if not runs:
            return []
        return [t[1:] for t in self.sp.decode([[self.lead, *ids] for ids in runs], num_threads=1)]  # behind another piece the mark is not dropped

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = list(map(self.chunks, texts))
        self.learn(found)
        return [[int(i) for c in own for i in self.csv[c].split(",")] for own in found]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded text, of each text."""
        out = []
        for at in range(0, len(texts), 64):
            found = list(map(self.chunks, texts[at : at + 64]))
            self.learn(found)
            for own in found:
                ids = ",".join(map(self.csv.__getitem__, own))
                back = "".join(map(self.plain.__getitem__, own))[1:]
                out.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of an id sequence: cut before each marked piece, every distinct run decoded once."""
        runs, start = [], 0
        for k, i in enumerate(ids):
            if k and self.sp.id_to_piece(int(i)).startswith(MARK):
                runs.append(tuple(ids[start:k]))
                start = k
        runs.append(tuple(ids[start:]))
        distinct = [run for run in set(runs) if run]
        known = dict(zip(distinct, self._decode(distinct)))
        out = "".join(known[run] for run in runs if run)
        return out[1:] if ids and self.sp.id_to_piece(int(ids[0])).startswith(MARK) else out


_TABLES: dict[str, ChunkTable] = {}


def _table(model_file: str) -> ChunkTable:
    if model_file not in _TABLES:
        _TABLES[model_file] = ChunkTable(model_file)
    return _TABLES[model_file]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id column and ``ids array<int>`` of every text."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col], docs[text_col].cast("string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_file)
        for batch in batches:
            ids = pa.array(table.encode([t.as_py() or "" for t in batch.column(1)]), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    return rows.mapInArrow(work, f"`{id_col}` {dict(rows.dtypes)[id_col]}, ids array<int>")


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Id column and decoded ``text`` of every id sequence (null: empty)."""
    small_batches(encoded.sparkSession)
    rows = encoded.select(encoded[id_col], encoded[ids_col])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_file)
        for batch in batches:
            text = pa.array([table.decode(i.as_py() or []) for i in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), text], [id_col, "text"])

    return rows.mapInArrow(work, f"`{id_col}` {dict(rows.dtypes)[id_col]}, text string")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded through the table."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", docs["text"].cast("string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_file)
        for batch in batches:
            n, ids, back = zip(*table.digests([t.as_py() or "" for t in batch.column(1)])) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
