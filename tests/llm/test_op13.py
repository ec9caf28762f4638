import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from tessera.llm import op13_packing as op

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def exact():
    return tokenizers.Tokenizer.from_file(FILES[0])


def best_fit(lengths, capacity):
    """Best-fit decreasing, one piece at a time: the number of sequences."""
    gaps = np.zeros(capacity + 1, int)
    used = 0
    for length in sorted(lengths, reverse=True):
        able = np.flatnonzero(gaps[length:])
        if len(able):
            gap = length + able[0]
            gaps[gap] -= 1
        else:
            gap, used = capacity, used + 1
        gaps[gap - length] += 1
    return used


def check(rows, lengths, capacity):
    """Every piece has a place, and those of a sequence lie gapless from 0 within the capacity."""
    assert sorted(r.length for r in rows) == sorted(lengths)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def frame(spark, lengths):
    return spark.createDataFrame([(i, 0, 0, int(n), i) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")


RNG = np.random.default_rng(4)
CASES = {
    "long tail": np.minimum(1024, RNG.lognormal(5, 1.2, 3000).astype(int) + 1),
    "even": RNG.integers(1, 1025, 2000),
    "thirds": RNG.integers(330, 360, 1000),
    "pairs": np.repeat([600, 400], 500),
    "one length": np.full(700, 400),
    "tiny": np.concatenate([np.ones(5000, int), RNG.integers(2, 9, 1000), [1024] * 5, [700] * 9]),
    "half and more": RNG.integers(500, 530, 900),
    "one": np.array([1]),
}


@pytest.mark.parametrize("name", CASES)
def test_valid_and_as_few_as_best_fit(spark, monkeypatch, name):
    monkeypatch.setattr(op, "SALT_ROWS", 100)
    lengths = CASES[name]
    used = check(op.pack(frame(spark, lengths).repartition(3)).collect(), lengths, 1024)
    least, best = -(-int(lengths.sum()) // 1024), best_fit(lengths, 1024)
    assert used >= least and used <= best + max(1, best // 200), (used, best, least)


def test_sweeps_of_ranges_and_of_all_agree():
    rng = np.random.default_rng(5)
    pieces = [(0, int(s), 0, int(rng.integers(1, 9)), None, None, None) for s in rng.choice(np.arange(1, 100), 40, replace=False)]
    gaps = [(1, int(s), 100 * i, int(rng.integers(1, 9)), None, None, None) for i, s in enumerate(rng.integers(1, 100, 40))]
    whole = op.sweep(pieces + gaps)
    parts = [r for k in range(10) for r in op.sweep([r for r in pieces + gaps if r[1] // 10 == k])]
    merged = op.sweep(parts)
    tokens = lambda rows: sum(r[1] * r[3] for r in rows if r[0] == 2)
    assert tokens(merged) == tokens(whole)
    left = lambda rows: sorted(r[:4] for r in rows if r[0] < 2)
    assert sum(n for k, _, _, n in left(merged) if k == 0) == sum(n for k, _, _, n in left(whole) if k == 0)
    assert not [1 for k, s, *_ in left(merged) if k == 0 for j, g, *_ in left(merged) if j == 1 and g >= s]


def test_pieces_of_documents(spark, exact):
    rows = [(1, "A first text. " * 600), (2, None), (3, ""), (3, ""), (4, "x <|endoftext|>  y\n\n z"), (None, " " * 12_000 + "end"), (6, "word " * 250_000), (7, "é" * 3000 + "\x00")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as piece", "8 as length")
    got = op.encode_pieces(df, *FILES).collect()
    want = []
    for i, text in rows:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or min(1024, len(ids))
        ends = list(range(first, len(ids) + 1, 1024))
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip([0, *ends], ends))]
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    check(op.pack(op.encode_pieces(df, *FILES)).collect(), [w[3] for w in want], 1024)


def test_the_fast_library_gives_the_same_ids(exact, monkeypatch):
    fast = op.Encoder.of(*FILES)
    for start in [*range(0, 0x32400, 512), *range(0xE0000, 0xE0200, 512)]:
        chars = [chr(c) for c in range(start, start + 512) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b 1{c}2 .{c}. {c}{c} x{c} 's{c}" for c in chars)
        assert fast.encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(op, "BLOCK", 3)
    rng = np.random.default_rng(6)
    for _ in range(1500):
        text = "".join(rng.choice(["a", "b ", " ", "\n", "'s", "12", " é", "　", "<|endoftext|>", ".", "\t", "'"], rng.integers(1, 25)))
        assert fast.encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op.pack(op.encode_pieces(df, *FILES)).count() == 0
