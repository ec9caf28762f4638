"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from four patterns (email, ip, card, phone) with their checks. The field then labels
the tokens that hold a digit, ``@`` or ``+``: token shapes give unary potentials, neighbouring tokens
share linear-chain potentials, and the occurrences of the same or a similar token (same digits, or
same mail name) anywhere in the document share skip potentials with their hub: the last one before them that is a base span, else
the first base span, or the first occurrence where none is. Loopy sum-product message passing runs over
all documents of a batch at once until the messages settle; tokens of base spans are clamped to their kind, so that a mention
found in one place makes its repetitions agree, however many there are. Tokens whose marginal for a kind reaches ``threshold`` are added.

The weights are learned by pseudo-likelihood on the tokens of a bounded sample of documents
(``SAMPLE_DOCS`` by hash of the id, of each ``DOC_TOKENS`` tokens at most and ``SAMPLE_TOKENS`` of all, those with the least digests of
id and place, so that neither one document nor the layout of the files decides), with base spans as labels; the skip potentials are
learned on pairs of successive occurrences.

Defined results: null text counts as empty and gives no span and the digest of the empty string; a
text of any length is read whole, in time linear in its length; repeated rows give repeated rows; an
empty table gives an empty one; further columns are not read. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, DOC_TOKENS, SAMPLE_TOKENS = 4000, 200, 20_000
THRESHOLD, DAMPING, CLAMP = 0.5, 0.5, 30.0
#: A message rests while its changes are below SETTLED; after each ROUNDS changes its steps are halved, so that one that swings settles too.
SETTLED, ROUNDS = 1e-6, 100

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARKED = re.compile(r"[0-9@+]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_SPACES = frozenset(" \t\n\v\f\r")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(d // 5 + d * 2 % 10 for d in map(int, digits[-2::-2])) if len(digits) > 1 else 0
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans, sorted.

    An address is looked for around each ``@``: every start before it would need the same ``@``, so the
    leftmost one is the start of the run of name characters, after the last match.
    """
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        if at > done and text[at - 1] in _LOCAL and (m := _DOMAIN.match(text, at + 1)):
            start = at - 1
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the words that hold a digit, ``@`` or ``+``."""
    out, end = [], 0
    m = _MARKED.search(text)
    while m:
        start = m.start()
        while start > end and text[start - 1] not in _SPACES:
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        out.append((start, end))
        m = _MARKED.search(text, end)
    return out


N_SHAPES = 23


def shape(word: str) -> list[int]:
    """Numbers of the features that a token has."""
    digits = _DIGIT.findall(word)
    n = len(digits)
    on = [0, 1 + (n > 0) + (n > 3) + (n > 6) + (n > 8) + (n > 11) + (n > 15) + (n > 19)]
    core = word.strip(".,;:!?\"'()[]{}<>|")
    tests = (
        "@" in word, "@" in core[1:] and "." in core.rpartition("@")[2], core.startswith("+"), core.count(".") == 3, core.isdigit(),
        any(map(str.isalpha, core)), "(" in word or ")" in word, "-" in core, len(core) > 24, core.replace(".", "").isdigit() and "." in core,
        12 <= n <= 19 and luhn("".join(digits)), 12 <= n <= 19 and not luhn("".join(digits)), len(word) > 200,
    )
    return on + [10 + k for k, t in enumerate(tests) if t]


def similar_key(word: str) -> str | None:
    """Tokens with the same key share a skip potential: the name of an address, or the last ten digits, or the word itself."""
    name, at, _ = word.lower().partition("@")
    if at and name:
        return name.strip(".,;:!?\"'()[]{}<>|")
    core = word.lower().strip(".,;:!?\"'()[]{}<>|+")
    if _LONG_NUMBER.fullmatch(core):
        return re.sub("[^0-9]", "", core)[-10:]
    return core if len(core) >= 6 else None


_LONG_NUMBER = re.compile(r"[0-9().-]{7,}")


class Graph:
    """Tokens of many documents: features, given labels (-1: none), edges of both kinds, and pairs of successive occurrences."""

    def __init__(self):
        self.rows: list[int] = []
        self.cols: list[int] = []
        self.given: list[int] = []
        self.where: list[tuple[int, int, int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.successive: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        found = tokens(text)
        mentions: dict[str, list[int]] = {}
        chained: set[int] = set()
        b = 0
        for t, (start, end) in enumerate(found):
            i = len(self.given)
            while b < len(base) and base[b][2] <= start:
                b += 1
            hit = next((k for s, k, e in base[b : b + 4] if s < end and e > start), -1)
            self.given.append(hit + 1 if hit >= 0 else -1)
            self.where.append((doc, start, end))
            on = shape(text[start:end])
            self.rows += [i] * len(on)
            self.cols += on
            if t and found[t - 1][1] + 1 >= start:
                self.chain.append((i - 1, i))
                chained.add(i)
            if key := similar_key(text[start:end]):
                mentions.setdefault(key, []).append(i)
        for own in mentions.values():
            self.successive += [(a, i) for a, i in zip(own, own[1:]) if a < i - 1 or i not in chained]
            hub = next((i for i in own if self.given[i] >= 0), own[0])
            for i in own:
                if self.given[i] >= 0:
                    hub = i
                elif i != hub and (self.given[hub] >= 0 or hub < i - 1 or i not in chained):
                    self.skip.append((hub, i))


def _edges(pairs: list[tuple[int, int]]) -> np.ndarray:
    return np.array(pairs, np.int64).reshape(-1, 2)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(graph: Graph, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Node marginals by loopy belief propagation with damped, simultaneous updates of the messages that have not settled."""
    n, k = len(graph.given), unary.shape[0]
    theta = np.zeros((n, k))
    np.add.at(theta, np.array(graph.rows, np.int64), unary.T[np.array(graph.cols, np.int64)])
    given = np.array(graph.given, np.int64)
    known = np.nonzero(given >= 0)[0]
    theta[known, given[known]] += CLAMP
    c, s = _edges(graph.chain), _edges(graph.skip)
    src = np.concatenate([c[:, 0], c[:, 1], s[:, 0], s[:, 1]])
    dst = np.concatenate([c[:, 1], c[:, 0], s[:, 1], s[:, 0]])
    pots = np.stack([chain, chain.T, skip, skip.T])
    pot = np.repeat(np.arange(4), [len(c), len(c), len(s), len(s)])
    back = np.concatenate([np.arange(len(c)) + len(c), np.arange(len(c)), 2 * len(c) + np.arange(len(s)) + len(s), 2 * len(c) + np.arange(len(s))])
    by = np.argsort(src, kind="stable")  # the edges out of a node, from start[node]
    start = np.searchsorted(src[by], np.arange(n + 1))
    message, times = np.zeros((len(src), k)), np.zeros(len(src), np.int64)
    # tokens of base spans take no messages, which in great numbers would outweigh the clamp
    free = given[dst] < 0
    belief, live = theta.copy(), np.flatnonzero(free)
    while len(live):
        out = _log_sum((belief[src[live]] - message[back[live]])[:, :, None] + pots[pot[live]], 1)
        step = (1 - DAMPING) * 0.5 ** (times[live] // ROUNDS)
        change = step[:, None] * (out - _log_sum(out, 1)[:, None] - message[live])
        message[live] += change
        times[live] += 1
        np.add.at(belief, dst[live], change)
        moved = live[np.abs(change).max(1) > SETTLED]
        # next: what moves itself, and what leaves the nodes that moved messages reach
        to = np.unique(dst[moved])
        many = start[to + 1] - start[to]
        reached = by[np.repeat(start[to] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        live = np.union1d(moved, reached[free[reached]])
    return np.exp(belief - _log_sum(belief, 1)[:, None]) if n else belief


def _sample(docs: DataFrame) -> list[tuple]:
    """Token rows of the sample, by digest: features, label, and the neighbours' labels by kind of edge."""
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    docs = docs.filter(F.col("text").rlike("[0-9@+]") & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = Graph()
            for d, t in enumerate(batch.column(1)):
                text = t.as_py() or ""
                g.add(d, text, base_spans(text))
            named = [str(i.as_py()) for i in batch.column(0)]
            digest = [hashlib.sha256(f"{named[d]}:{start}".encode()).hexdigest() for d, start, _ in g.where]
            chosen, of = [], Counter()
            for i in sorted(range(len(digest)), key=digest.__getitem__):
                of[g.where[i][0]] += 1
                if of[g.where[i][0]] <= DOC_TOKENS:
                    chosen.append(i)
            label = np.maximum(np.array(g.given, np.int64), 0)
            on, near = [[] for _ in label], np.zeros((len(label), 2, 5), np.int64)
            for i, f in zip(g.rows, g.cols):
                on[i].append(f)
            for kind, edges in enumerate((g.chain, g.successive)):
                for a, b in edges:
                    near[a, kind, label[b]] += 1
                    near[b, kind, label[a]] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest[i] for i in chosen], pa.string()), pa.array(label[chosen], pa.int64()), pa.array([on[i] for i in chosen], pa.list_(pa.int64())), pa.array(list(near.reshape(-1, 10)[chosen]), pa.list_(pa.int64()))],
                ["digest", "label", "features", "near"],
            )

    found = docs.mapInArrow(work, "digest string, label long, features array<long>, near array<long>")
    return found.orderBy("digest", "label", "features", "near").limit(SAMPLE_TOKENS).collect()


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unary (5 x features), chain and skip potentials (5 x 5) by regularised pseudo-likelihood."""
    rows = _sample(docs)
    k = len(KINDS) + 1
    if not rows:
        return np.zeros((k, N_SHAPES)), np.zeros((k, k)), np.zeros((k, k))
    x = np.zeros((len(rows), N_SHAPES + 10))
    for i, r in enumerate(rows):
        x[i, r.features] = 1
        x[i, N_SHAPES:] = r.near
    y = np.eye(k)[[r.label for r in rows]]
    # every token again without its shape, so that the potentials of the edges carry labels where a shape is unclear
    bare = x.copy()
    bare[:, 1:N_SHAPES] = 0
    x, y = np.concatenate([x, bare]), np.concatenate([y, y])
    w = np.zeros((x.shape[1], k))
    first = second = np.zeros_like(w)
    for step in range(1, 301):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x.T @ (p - y) / len(x) + 1e-3 * w
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w = w - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    chain, skip = w[N_SHAPES : N_SHAPES + 5], w[N_SHAPES + 5 :]
    return w[:N_SHAPES].T.copy(), (chain + chain.T) / 2, (skip + skip.T) / 2


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts of base spans by kind, digest of the base spans, all spans, number of added ones."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    weights = train(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, base = Graph(), []
            for d, t in enumerate(batch.column(1)):
                text = t.as_py() or ""
                base.append(base_spans(text))
                g.add(d, text, base[-1])
            every: list[list] = [list(b) for b in base]
            p = marginals(g, *weights)
            for i in np.nonzero((np.array(g.given, np.int64) < 0) & (p[:, 1:].max(1, initial=0) >= threshold))[0]:
                d, start, end = g.where[i]
                every[d].append((start, int(p[i, 1:].argmax()), end))
            say = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
            counts = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(4)]
            cols = [pa.array(c, pa.int64()) for c in counts]
            cols += [pa.array([hashlib.sha256(say(b).encode()).hexdigest() for b in base], pa.string()), pa.array(list(map(say, every)), pa.string())]
            cols.append(pa.array([len(e) - len(b) for e, b in zip(every, base)], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, {kinds}, base_sha256 string, spans string, n_added long")
