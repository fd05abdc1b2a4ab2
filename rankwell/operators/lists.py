"""Sums of products over what pairs share, without a row for each pair.

``own`` rows (a, other, x) say which lists an ``a`` meets, a list of ``other`` holds entries (b, y, ...).
For all (a, b) the products of x and y are added up over the lists, as in a product of two sparse
matrices. Every a lies in one block, a hash of it. A copy of a list goes to each block that asks for it,
where its entries meet the rows of the block. So all partners of an a are found in one task, piece by
piece, and only its best ones leave it. What a task sends to a block, rows and lists, goes there in
bundles of many: like bytes together, compressed.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The functions below travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Products of a block, about, in blocks of asked pairs; and those worked out at once.
BLOCK_PRODUCTS, PIECE = 2**22, 2**20
# The same where lists meet: a block holds at most as many entries, about nine bytes each, and the fewer blocks
# there are, the fewer copies. Down to BLOCK_PRODUCTS there are BLOCKS_A_CORE blocks for each core.
MET_PRODUCTS, BLOCKS_A_CORE = 2**25, 3
# Entries or rows that a task gathers before it sends them out.
BUNDLE_ROWS = 2**21
_LIST, _TABLE = 0, 1
# Stands for a null b; nulls come first in ascending order, and so does this.
NULL_ID = -(2**63)


def pack(ids: np.ndarray, values: Sequence[np.ndarray], nulls: np.ndarray) -> bytes:
    """Entries as bytes: gaps of sorted ids and the values, like bytes together, compressed."""
    order = np.argsort(ids, kind="stable")
    columns = [np.diff(ids[order], prepend=np.int64(0)), *[v[order] for v in values]]
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns) + nulls[order].tobytes()
    return len(ids).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, values as rows, bits of the values that are null) of packed entries with ``width`` values."""
    n = int.from_bytes(packed[:8], "little")
    raw = np.frombuffer(pa.decompress(packed[8:], n * (8 * (width + 1) + 1), codec="zstd"), np.uint8)
    columns = np.ascontiguousarray(raw[: -n or None].reshape(width + 1, 8, n).transpose(0, 2, 1)).view(np.int64)[..., 0]
    return np.cumsum(columns[0]), columns[1:].view(np.float64), raw[raw.size - n :]


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as bytes: like bytes together, those that are 0 throughout left out, compressed."""
    head, body = [], []
    for array in arrays:
        planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
        there = [i for i, plane in enumerate(planes) if plane.any()]
        head += [len(array), sum(1 << i for i in there)]
        body += [planes[i].tobytes() for i in there]
    raw = b"".join(body)
    return np.array([len(raw), *head], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_arrays(packed: pa.Buffer, kinds: Sequence[str]) -> list[np.ndarray]:
    """The arrays, of types ``kinds``, that ``pack_arrays`` packed."""
    head = np.frombuffer(packed, "<i8", 1 + 2 * len(kinds)).tolist()
    raw = np.frombuffer(pa.decompress(packed.slice(8 * (1 + 2 * len(kinds))), head[0], codec="zstd"), np.uint8)
    out, at = [], 0
    for kind, n, there in zip(kinds, head[1::2], head[2::2]):
        planes = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
        for i in range(planes.shape[1]):
            if there >> i & 1:
                planes[:, i] = raw[at : at + n]
                at += n
        out.append(planes.reshape(-1).view(kind))
    return out


def spread_out(size: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The places of lines of ``size`` entries, one line after the other, that begin at ``start``."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat((before if start is None else start) - before, size)


def packed_lists(rows: DataFrame, other: str, b: str, values: Sequence[str], list_rows: int) -> DataFrame:
    """(other, list): the entries (b, values) of each ``other``, long lists in several of about ``list_rows``."""
    held = rows.filter(F.col(other).isNotNull()).select(F.col(other).cast("long").alias("other"), F.col(b).cast("long").alias("b"), *[F.col(v).cast("double").alias(v) for v in values])
    long = held.groupBy("other").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > list_rows)
    long = long.select("other", F.ceil(F.col("n") / list_rows).cast("int").alias("parts"))
    held = held.join(long, "other", "left").withColumn("part", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))))
    lists = held.groupBy("other", "part").agg(F.collect_list(F.struct("b", *values)).alias("entries"))

    @F.arrow_udf("binary")
    def packing(entries: pa.Array) -> pa.Array:
        flat, at = entries.flatten(), entries.offsets.to_numpy() - entries.offsets[0].as_py()
        ids = flat.field("b").fill_null(NULL_ID).to_numpy()
        columns = [flat.field(v) for v in values]
        nulls = np.zeros(len(flat), np.uint8)
        for bit, column in enumerate(columns):
            nulls |= column.is_null().to_numpy(zero_copy_only=False).astype(np.uint8) << bit
        columns = [c.fill_null(0.0).to_numpy() for c in columns]
        return pa.array([pack(ids[i:j], [c[i:j] for c in columns], nulls[i:j]) for i, j in zip(at[:-1], at[1:])], pa.binary())

    return lists.select("other", packing("entries").alias("list"))


def bundled_lists(width: int):
    """Lists (blocks, other, list) in bundles for the blocks."""

    def bundles(held) -> Iterator[pa.RecordBatch]:
        to = [blocks for blocks, *_ in held]
        line = np.repeat(np.arange(len(held)), [len(blocks) for blocks in to])
        to = np.concatenate(to)
        others = np.array([other for _, other, _ in held], np.int64)
        size = np.array([len(ids) for *_, (ids, _, _) in held], np.int64)
        start = np.cumsum(size) - size
        ids = np.concatenate([ids for *_, (ids, _, _) in held])
        gaps = np.diff(ids, prepend=np.int64(0))
        gaps[start] = ids[start]
        values = np.concatenate([values for *_, (_, values, _) in held], axis=1)
        nulls = np.concatenate([nulls for *_, (_, _, nulls) in held])
        order = np.lexsort((others[line], to))
        to, line = to[order], line[order]
        first = np.flatnonzero(np.diff(to, prepend=-1))
        for low, high in zip(first, [*first[1:], len(to)]):
            some = line[low:high]
            at = spread_out(size[some], start[some])
            data = pack_arrays(np.diff(others[some], prepend=np.int64(0)), size[some], gaps[at], *[v[at] for v in values], nulls[at])
            yield pa.record_batch([pa.array([to[low]], pa.int32()), pa.array([_LIST], pa.int32()), pa.array([data], pa.binary())], ["block", "kind", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            places = batch.column(0)
            ends = places.offsets.to_numpy() - places.offsets[0].as_py()
            places = places.flatten().to_numpy()
            for i, (other, packed) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                entries = unpack(packed, width)
                held.append((places[ends[i] : ends[i + 1]], other, entries))
                n += len(entries[0])
                if n >= BUNDLE_ROWS:
                    yield from bundles(held)
                    held, n = [], 0
        if held:
            yield from bundles(held)

    return run


def unpack_lists(packed: pa.Buffer, width: int) -> tuple:
    """(others, sizes, ids, values, null bits) of the lists in a bundle."""
    other, n, gaps, *values, nulls = unpack_arrays(packed, ["i8"] * 3 + ["f8"] * width + ["u1"])
    # The ids of a list add up from its first one.
    total, start = np.cumsum(gaps), np.cumsum(n) - n
    return np.cumsum(other), n, total - np.repeat(total[start] - gaps[start], n), values, nulls


def _bundled_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, a, other, x) in bundles for the blocks."""

    def bundles(held) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        block, a, other = (t[c].to_numpy() for c in ("block", "a", "other"))
        x, null = t["x"].fill_null(0.0).to_numpy(), t["x"].is_null().to_numpy().astype(np.uint8)
        order = np.lexsort((other, a, block))
        block, a, other, x, null = (c[order] for c in (block, a, other, x, null))
        first = np.flatnonzero(np.diff(block, prepend=-1))
        for i, j in zip(first, [*first[1:], len(block)]):
            data = pack_arrays(np.diff(a[i:j], prepend=np.int64(0)), other[i:j], x[i:j], null[i:j])
            yield pa.record_batch([pa.array([block[i]], pa.int32()), pa.array([data], pa.binary())], ["block", "data"])

    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= BUNDLE_ROWS:
            yield from bundles(held)
            held, n = [], 0
    if n:
        yield from bundles(held)


def _bundled_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, id, numbers) in bundles, to be copied to all blocks."""
    for batch in batches:
        if batch.num_rows:
            columns = [c.to_numpy() for c in batch.columns]
            gaps = [np.diff(c, prepend=np.int64(0)) for c in columns[:2]]
            yield pa.record_batch([pa.array([pack_arrays(*gaps, *columns[2:])], pa.binary())], ["data"])


def _unpacked(data: pa.ChunkedArray, kinds: Sequence[str]) -> Iterator[list[np.ndarray]]:
    for packed in data:
        yield unpack_arrays(packed.as_buffer(), kinds)


def narrow(values: np.ndarray) -> np.ndarray:
    """Numbers in half the bytes if that is exact."""
    small = np.int32 if values.dtype == np.int64 else np.float32
    with np.errstate(all="ignore"):
        less = values.astype(small)
        return less if np.array_equal(less, values) else values


def _block(width: int, terms: Callable, best: Callable, in_table: int = 0):
    """Cogroup function: the rows of a block against the lists they ask for, both as they are or in bundles."""
    no_rows = np.zeros(0, np.int64)

    def rows_of(left: pa.Table) -> list[np.ndarray]:
        """(a, other, x, whether x is null)."""
        if "data" not in left.column_names:
            return [left["a"].to_numpy(), left["other"].to_numpy(), left["x"].fill_null(0.0).to_numpy(), left["x"].is_null().to_numpy()]
        return [np.concatenate(c) for c in zip(*((np.cumsum(a), *rest) for a, *rest in _unpacked(left["data"], ["i8", "i8", "f8", "u1"])))]

    def parts_of(right: pa.Table) -> Iterator[tuple]:
        """(others, sizes, ids, values, null bits) of some lists at a time."""
        if "data" not in right.column_names:
            for other, packed in zip(right["other"].to_pylist(), right["list"].to_pylist()):
                entries, values, nulls = unpack(packed, width)
                yield np.array([other]), np.array([len(entries)]), entries, list(values), nulls
            return
        for packed in right["data"]:
            yield unpack_lists(packed.as_buffer(), width)

    def lists(right: pa.Table):
        """(others, sizes, starts, ids, values, null bits or None) of all lists, by other."""
        others, size, ids, values, nulls = [], [], [], [], []
        for other, n, entries, numbers, bits in parts_of(right):
            ids.append(narrow(entries))
            others.append(other)
            size.append(n)
            values.append([narrow(v) for v in numbers])
            nulls.append(bits if bits.any() else None)
        if any(part is not None for part in nulls):
            nulls = np.concatenate([np.zeros(len(i), np.uint8) if part is None else part for i, part in zip(ids, nulls)])
        else:
            nulls = None
        others, size, ids = np.concatenate(others), np.concatenate(size), np.concatenate(ids)
        values = [np.concatenate([part[i] for part in values]) for i in range(width)]
        start = np.cumsum(size) - size
        order = np.argsort(others, kind="stable")
        return others[order], size[order], start[order], ids, values, nulls

    def table(data: pa.ChunkedArray) -> list[np.ndarray]:
        """The columns (id, numbers) by place."""
        parts = list(_unpacked(data, ["i8"] * 2 + ["f8"] * (in_table - 1)))
        place = np.concatenate([no_rows, *[np.cumsum(p[0]) for p in parts]])
        columns = [np.concatenate([no_rows, *[np.cumsum(p[1]) for p in parts]])]
        columns += [np.concatenate([np.zeros(0), *[p[i] for p in parts]]) for i in range(2, in_table + 1)]
        del parts
        out = [np.zeros_like(c) for c in columns]
        for new, old in zip(out, columns):
            new[place] = old
        return out

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        held = None
        if in_table:
            of_table = pa.array(right["kind"].to_numpy() == _TABLE)
            held, right = table(right["data"].filter(of_table)), right.filter(pc.invert(of_table))

        def each(b: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
            return [b, *values] if held is None else [column[b] for column in held]

        nothing = best(no_rows, no_rows, [], each(no_rows, [np.zeros(0)] * width))
        if not (left.num_rows and right.num_rows):
            return nothing
        own = rows_of(left)
        order = np.lexsort((own[1], own[0]))
        a, asked, x, no_x = (c[order] for c in own)
        no_x = no_x > 0
        others, size, start, ids, values, nulls = lists(right)
        low, high = np.searchsorted(others, asked, "left"), np.searchsorted(others, asked, "right")
        # One line per row and list: a long list is several.
        row = np.repeat(np.arange(len(a)), high - low)
        place = spread_out(high - low, low)
        length = size[place]
        ends = np.cumsum(length)
        found, rest, at = [], None, 0
        while at < len(row):
            until = max(at + 1, int(np.searchsorted(ends, (ends[at] - length[at]) + PIECE, "right")))
            n = length[at:until]
            entry = spread_out(n, start[place[at:until]])
            mine = np.repeat(row[at:until], n)
            b = ids[entry].astype(np.int64)
            met = [v[entry].astype(np.float64) for v in values]
            sums = terms(x[mine], no_x[mine], a[mine], asked[mine], met, np.zeros(len(b), np.uint8) if nulls is None else nulls[entry])
            piece = _added(a[mine], b, sums, met if held is None else [])
            if rest is not None:
                piece = _added(*(np.concatenate(c) for c in zip(rest[:2], piece[:2])), *[[np.concatenate(c) for c in zip(*both)] for both in zip(rest[2:], piece[2:])])
            # The last a may go on in the next piece.
            done = np.searchsorted(piece[0], a[row[until]]) if until < len(row) else len(piece[0])
            found.append(best(piece[0][:done], piece[1][:done], [s[:done] for s in piece[2]], each(piece[1][:done], [v[:done] for v in piece[3]])))
            rest = (piece[0][done:], piece[1][done:], *[[c[done:] for c in columns] for columns in piece[2:]])
            at = until
        return pa.concat_tables(found) if found else nothing

    return work


def _order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The stable order by (a, b); ``a`` comes in few runs of equal values, which may repeat."""
    if not len(a):
        return np.zeros(0, np.int64)
    low_a, low_b = int(a.min()), int(b.min())
    bits = [(int(a.max()) - low_a).bit_length(), (int(b.max()) - low_b).bit_length(), len(a).bit_length()]
    if sum(bits) > 63 and (np.diff(a) >= 0).all():
        a, low_a = np.cumsum(np.diff(a, prepend=a[0]) > 0), 0
        bits[0] = int(a[-1]).bit_length()
    if sum(bits) > 63:
        return np.lexsort((b, a))
    # Numbers with the place as their last digits are sorted faster than places by keys.
    keys = (((a - low_a) << bits[1] | (b - low_b)) << bits[2]) | np.arange(len(a))
    keys.sort()
    return keys & ((1 << bits[2]) - 1)


def _added(a: np.ndarray, b: np.ndarray, sums: Sequence[np.ndarray], same: Sequence[np.ndarray]):
    """The sums of each (a, b), sorted by them, and the numbers that are the same on all of its rows."""
    order = _order(a, b)
    a, b = a[order], b[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
    return a[first], b[first], [np.add.reduceat(s[order], first) if len(a) else s for s in sums], [v[order[first]] for v in same]


def first_of_each(a: np.ndarray, b: np.ndarray, score: np.ndarray, null: np.ndarray, n: int):
    """(places, ranks) of the ``n`` entries of each a with the greatest scores, NaN first, null last, ties by b."""
    key = np.where(null, np.inf, np.where(np.isnan(score), -np.inf, -score)) + 0.0
    some = _foremost(a, key, n)
    order = some[np.lexsort((b[some], key[some], a[some]))]
    rank = np.arange(len(order)) - np.searchsorted(a[order], a[order])
    return order[rank < n], rank[rank < n] + 1


def _foremost(a: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Places that hold the ``n`` least keys of each a, and what is equal to the last of them as a float of 32 bits."""
    if not len(a) or (np.diff(a) < 0).any():
        return np.arange(len(a))
    line = np.cumsum(np.diff(a, prepend=a[0]) > 0)
    with np.errstate(over="ignore"):
        bits = key.astype(np.float32).view(np.int32)
    # Whole numbers in the order of the floats.
    whole = (line << 32) + np.where(bits < 0, bits ^ 0x7FFFFFFF, bits) + 2**31
    start = np.searchsorted(line, np.arange(line[-1] + 2))
    last = np.sort(whole)[np.minimum(start[:-1] + n, start[1:]) - 1]
    return np.flatnonzero(whole <= last[line])


def meet_lists(
    own: DataFrame,
    lists: DataFrame,
    sizes: DataFrame,
    width: int,
    terms: Callable,
    best: Callable,
    schema: str,
    table: DataFrame | None = None,
    block_products: int | None = None,
) -> DataFrame:
    """What ``best`` keeps of the sums of each a: ``own`` (a, other, x) met with ``lists`` (see ``packed_lists``).

    ``terms`` (x, null x, a, other, values, null bits) gives the numbers to add up for rows that met,
    ``best`` (a, b, sums, b and its values) a table of ``schema``. ``sizes`` (other, n) are the entries of each
    list. With a ``table`` (place, id, numbers), places from 0 without a gap, every b is a place in it; it is sent
    to all blocks, and ``best`` gets the id and the numbers of b from there.
    """
    own = own.filter("a is not null and other is not null").select(F.col("a").cast("long").alias("a"), F.col("other").cast("long").alias("other"), F.col("x").cast("double").alias("x"))
    asked = own.groupBy("other").agg(F.count(F.lit(1)).alias("asked"))
    products = sizes.select(F.col("other").cast("long").alias("other"), "n").join(asked, "other").agg(F.sum(F.col("n").cast("double") * F.col("asked"))).first()[0] or 0
    if block_products is None:
        busy = own.sparkSession.sparkContext.defaultParallelism * BLOCKS_A_CORE
        blocks = max(products / MET_PRODUCTS, min(products / BLOCK_PRODUCTS, busy))
    else:
        blocks = products / block_products
    blocks = min(2**20, max(1, int(blocks) + 1))
    block = F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int").alias("block")
    placed = own.select(block, "a", "other", "x")
    wanted = placed.groupBy("other").agg(F.collect_set("block").alias("blocks"))
    rows = placed.mapInArrow(_bundled_own, "block int, data binary")
    kinds = "block int, kind int, data binary"
    copies = lists.join(wanted, "other").select("blocks", "other", "list").mapInArrow(bundled_lists(width), kinds)
    if table is not None:
        parts = table.mapInArrow(_bundled_table, "data binary")
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        copies = copies.unionByName(parts.select(everywhere, F.lit(_TABLE).alias("kind"), "data"))
    in_table = 0 if table is None else len(table.columns) - 1
    return rows.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(_block(width, terms, best, in_table), schema)
