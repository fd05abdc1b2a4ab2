"""Byte-level BPE: pre-tokenisation by transition functions, cached pair merging, decoding.

Pre-tokenisation runs over arrays of codepoint classes. Each class is a transition function of
a small automaton; functions compose, so the state before every codepoint is a scan of an
associative operation and no regex is used. The slices between boundaries are merged once per
distinct slice and then looked up.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import as_bytes, buffer_of, slices, text_batches, with_struct

# Bytes of text handled at once, codepoints in a row of the scan, merged slices a worker keeps.
SLICE_BYTES = 250_000
SCAN_ROW = 256
CACHED_BYTES = 24_000_000
# Longer slices are merged but not kept; longer ones are merged with a heap of pairs.
KEPT_SLICE = 64
SCANNED_SLICE = 64

# Codepoint classes with what follows them: letter, number, other, an apostrophe before s, t, m
# or d, one before re, ve or ll, a space before a non-space, a white space before another or at
# the end, another white space before a non-space, and the end of a text.
L, N, O, Q1, Q2, S, W, X, END = range(9)  # noqa: E741
# States: at a token's end, in letters, in numbers, in others, after the space that joins what
# follows, in white space, with one or two letters of a contraction still to come.
AT_END, IN_L, IN_N, IN_O, JOINED, IN_W, ONE_LEFT, TWO_LEFT = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """(next state, whether a token starts at this codepoint)."""
    if kind == END:
        return AT_END, False
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return AT_END, False
    if kind == S:
        return JOINED, True
    if kind == X:
        return AT_END, True
    if kind == W:
        return IN_W, state != IN_W
    if kind in (Q1, Q2) and state not in (IN_O, JOINED):
        return (ONE_LEFT if kind == Q1 else TWO_LEFT), True
    run = {L: IN_L, N: IN_N}.get(kind, IN_O)
    return run, state not in (run, JOINED)


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The monoid that the classes' transition functions generate.

    Returns the element of each class, the product table (first, then second), the state each
    element leads to from AT_END, and whether a token starts, by state and class.
    """
    functions = [tuple(_step(s, k)[0] for s in range(8)) for k in range(9)]
    elements, at = [tuple(range(8))], 0
    place = {elements[0]: 0}
    while at < len(elements):
        for f in functions:
            g = tuple(f[s] for s in elements[at])
            if g not in place:
                place[g] = len(elements)
                elements.append(g)
        at += 1
    kind = np.uint8 if len(elements) <= 256 else np.uint16
    product = np.array([[place[tuple(b[s] for s in a)] for b in elements] for a in elements], kind)
    starts = np.array([[_step(s, k)[1] for k in range(9)] for s in range(8)])
    return np.array([place[f] for f in functions], kind), product, np.array([e[AT_END] for e in elements]), starts


@cache
def codepoint_kinds() -> np.ndarray:
    """Letter, number, other, or W for white space, of every codepoint."""
    kinds = np.full(sys.maxunicode + 2, O, np.uint8)
    for c in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(c))[0]
        if major in "LN":
            kinds[c] = L if major == "L" else N
    # White space of the pattern's \s: the White_Space property, not str.isspace.
    for c in [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        kinds[c] = W
    return kinds


def states_before(elements: np.ndarray) -> np.ndarray:
    """The automaton's state before each codepoint: a scan in rows, over row totals, and back."""
    _, product, leads, _ = automaton()
    n = len(elements)
    rows = -(-n // SCAN_ROW)
    grid = np.zeros(rows * SCAN_ROW, elements.dtype)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, SCAN_ROW).T)
    prefix = np.empty_like(grid)
    total = np.zeros(rows, elements.dtype)
    for j in range(SCAN_ROW):
        prefix[j] = total
        total = product[total, grid[j]]
    start = np.empty(rows, elements.dtype)
    now = 0
    for i, t in enumerate(total.tolist()):
        start[i] = now
        now = product[now, t]
    return leads[product[start[None, :], prefix]].T.reshape(-1)[:n]


def token_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a slice starts at each codepoint; ``points`` holds -1 at each place in ``ends``."""
    kinds = codepoint_kinds()[points]  # -1 reads the last entry, overwritten below
    kinds[ends] = END
    after = np.append(kinds[1:], END)
    space = kinds == W
    alone = space & (after != W) & (after != END)
    ahead = np.append(points[1:], -1)
    quote = np.flatnonzero(points == 0x27)
    one, two = ahead[quote], np.append(points[2:], [-1, -1])[quote]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    kinds[quote[single]] = Q1
    kinds[quote[double]] = Q2
    kinds[alone] = np.where(points[alone] == 32, S, X)
    of_class, _, _, starts = automaton()
    return starts[states_before(of_class[kinds]), kinds]


def load_ranks(lines) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the pair of least rank, leftmost first, is joined until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n <= SCANNED_SLICE:
        return _merge_short(piece, ranks)
    end = list(range(1, n + 1))  # by start: where its part ends; 0 once joined to the left
    before = list(range(-1, n - 1))
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != to:
            continue
        end[i], end[j] = to, 0
        if to < n:
            before[to] = i
            r = ranks.get(piece[i : end[to]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[to]))
        if i:
            h = before[i]
            r = ranks.get(piece[h:to])
            if r is not None:
                heapq.heappush(heap, (r, h, to))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by looking through all pairs for each join, which is quicker on few of them."""
    get, none = ranks.get, 1 << 32
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[part] for part in parts]


class Encoder:
    """Encodes and decodes arrays of texts with the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks lack a single byte")
        self.ranks = ranks
        self.kept: dict[bytes, bytes] = {}
        self.kept_bytes = 0
        size = max(ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank], self.length[rank] = token, len(token)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def _ids(self, piece: bytes) -> bytes:
        found = np.array(merge(piece, self.ranks), "<u4").tobytes()
        if len(piece) <= KEPT_SLICE:
            if self.kept_bytes > CACHED_BYTES:
                self.kept.clear()
                self.kept_bytes = 0
            self.kept[piece] = found
            self.kept_bytes += 120 + len(piece) + len(found)
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a binary array as little-endian unsigned 32-bit integers."""
        data, offsets = buffer_of(texts)
        raw = data.tobytes()
        # Codepoints with a mark after each text, and where each codepoint's bytes start.
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
        first = np.searchsorted(lead, offsets[1:])
        marked = np.insert(points, first, -1)
        place = np.insert(lead, first, offsets[1:])
        ends = first + np.arange(len(first))
        starts = token_starts(marked, ends)
        starts[ends] = True  # each text's end closes its last slice
        cut = np.flatnonzero(starts)
        at = place[cut]
        closing = np.searchsorted(cut, ends)
        bounds = at.tolist()
        pieces = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        get, make = self.kept.get, self._ids
        out, done = [], 0
        for last in closing.tolist():
            out.append(b"".join([get(p) or make(p) for p in pieces[done:last]]))
            done = last + 1
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token starts."""
        return np.concatenate([[0], np.cumsum(self.length[ids])])[:-1] if len(ids) else np.zeros(0, np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of the tokens, each put at its offset."""
        if not len(ids):
            return b""
        length = self.length[ids]
        size = int(offsets[-1] + length[-1])
        source = np.arange(size) + np.repeat(self.offset[ids] - offsets, length)
        return self.blob[source].tobytes()


@cache
def _encoder(name: str) -> Encoder:
    with open(SparkFiles.get(name), "rb") as lines:
        return Encoder(load_ranks(lines))


def _shared_ranks(df: DataFrame, path: str) -> str:
    """Sends the rank file (one vocabulary, its size fixed) to every executor; its name there."""
    text_batches(df.sparkSession)
    df.sparkSession.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def encode(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (binary, little-endian unsigned 32-bit) and offsets (array<int>).

    ``offsets`` holds the byte at which each token starts in the UTF-8 text. Texts are encoded
    whole and row by row, without special tokens; null and empty texts give no ids. Any other
    column passes through; input columns named ids or offsets are replaced.
    """
    name = _shared_ranks(docs, ranks_path)

    @F.arrow_udf("ids binary, offsets array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _encoder(name)
        for texts in batches:
            ids, places, sizes = [], [np.zeros(0, np.int32)], [0]
            for _, part in slices(as_bytes(texts), SLICE_BYTES):
                for found in coder.encode(part):
                    ids.append(found)
                    places.append(coder.offsets(np.frombuffer(found, "<u4")).astype(np.int32))
                    sizes.append(len(places[-1]))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(np.concatenate(places), pa.int32()))
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), lists], ["ids", "offsets"])

    return with_struct(docs, encoded(docs[f"`{text}`"]))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with decoded (binary): the bytes its ids and offsets stand for.

    Null ids give empty bytes.
    """
    name = _shared_ranks(encoded, ranks_path)

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        coder = _encoder(name)
        for ids, places in batches:
            ids, values = as_bytes(ids), places.values.to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = places.offsets.to_numpy()
            out = []
            for i, row in enumerate(ids):
                numbers = np.frombuffer(row.as_buffer(), "<u4")
                out.append(coder.decode(numbers, values[bounds[i] : bounds[i + 1]]))
            yield pa.array(out, pa.binary())

    return encoded.withColumn("decoded", decoded("ids", "offsets"))
