"""Sums of products for pairs somebody asks for, without a row for each pair.

A matrix has groups (users) by items. The sum of a pair (a, b) goes over the groups that hold both. Every
a lies in one block, a hash of it. A copy of a group's entries goes to each block that holds one of its
items as an a, in bundles of all that a task sends there. What is asked goes to the blocks too: as packed pairs, or as lists of
a's and b's, of which all pairs are meant. A block adds up the pairs that are asked in it, list by list, so
neither pairs nor products are ever shuffled.

An a in so many lists that they exceed a block has several blocks, among which its lists are dealt out.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.operators.lists import BLOCK_PRODUCTS, NULL_ID, PIECE, bundled_lists, narrow, pack, spread_out, unpack, unpack_lists
from rankwell.skew import checkpoint

# The functions below travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Types of ids that fit a long.
WHOLE = ("tinyint", "smallint", "int", "bigint")
# Entries of a packed list; longer ones are several.
LIST_ROWS = 2**16
# What a packed entry is: a partner (b), an item whose pairs are wanted (a), and whether its value is null.
PARTNER, OWN, NO_VALUE = 1, 2, 4
_MATRIX, _LISTS, _PAIRS = 0, 1, 2
_ROW = "block int, kind int, data binary"


def _mix(x: np.ndarray) -> np.ndarray:
    """Bits of longs stirred (the finisher of SplitMix64)."""
    x = np.ascontiguousarray(x, np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _place(a: np.ndarray, part: np.ndarray, blocks: int) -> np.ndarray:
    return (_mix(_mix(a) ^ part) & 0x7FFFFFFFFFFFFFFF) % blocks


def _parts(a: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many blocks each a has."""
    ids, parts = hot
    if not len(ids):
        return np.ones(len(a), np.int64)
    at = np.minimum(np.searchsorted(ids, a), len(ids) - 1)
    return np.where(ids[at] == a, parts[at], 1)


def _expanded(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, place in the line) of lines of ``n`` places each."""
    line = np.repeat(np.arange(len(n)), n)
    return line, np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)


def _packed(rows: DataFrame, kind: int, blocks: int, hot, longest: int, list_rows: int) -> DataFrame:
    """The rows (g, b, x, flags) as lists in bundles, one copy of a list for each block that has one of its own items."""
    rows = rows.withColumn("part", F.lit(0))
    if longest > list_rows:
        long = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > list_rows)
        parts = F.pmod(F.xxhash64("b"), F.coalesce(F.ceil(F.col("n") / list_rows), F.lit(1))).cast("int")
        rows = rows.join(long, "g", "left").withColumn("part", parts)
    grouped = rows.groupBy("g", "part").agg(F.collect_list(F.struct("b", "x", "flags")).alias("entries"))

    @F.arrow_udf("struct<list binary, blocks array<int>>")
    def packing(g: pa.Array, entries: pa.Array) -> pa.Array:
        flat, at = entries.flatten(), entries.offsets.to_numpy() - entries.offsets[0].as_py()
        ids = flat.field("b").fill_null(NULL_ID).to_numpy()
        x = flat.field("x").fill_null(0.0).to_numpy()
        flags = flat.field("flags").to_numpy().astype(np.uint8) | (flat.field("x").is_null().to_numpy(zero_copy_only=False).astype(np.uint8) * NO_VALUE)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        own = flags & OWN > 0
        a, row = ids[own], row[own]
        parts = _parts(a, hot)
        if kind == _MATRIX:
            line, part = _expanded(parts)
            a, row = a[line], row[line]
        else:
            part = (_mix(g.to_numpy())[row] & 0x7FFFFFFFFFFFFFFF) % parts
        wanted = np.unique(row * blocks + _place(a, part, blocks))
        ends = np.searchsorted(wanted, np.arange(len(at)) * blocks)
        lists = [pack(ids[i:j], [x[i:j]], flags[i:j]) for i, j in zip(at[:-1], at[1:])]
        places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(wanted % blocks, pa.int32()))
        return pa.StructArray.from_arrays([pa.array(lists, pa.binary()), places], ["list", "blocks"])

    packed = grouped.select("g", packing("g", "entries").alias("p")).select("g", "p.list", "p.blocks")
    if longest > list_rows:
        # The parts of a list go wherever one of them has to.
        packed = checkpoint(packed)
        everywhere = packed.groupBy("g").agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks"))
        packed = packed.drop("blocks").join(everywhere, "g")
    bundles = packed.select("blocks", F.col("g").alias("other"), "list").mapInArrow(bundled_lists(1), _ROW)
    return bundles.select("block", F.lit(kind).alias("kind"), "data")


def _packed_pairs(pairs: DataFrame, blocks: int) -> DataFrame:
    """Pairs (i1, i2) packed by blocks of i1; of a pair with one null the other item stands on both sides."""

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held):
            t = pa.Table.from_batches(held)
            no1, no2 = (t[c].is_null().to_numpy() for c in ("i1", "i2"))
            one, two = (t[c].fill_null(NULL_ID).to_numpy() for c in ("i1", "i2"))
            one, two = np.where(no1, two, one), np.where(no2, one, two)
            flags = no1.astype(np.uint8) | (no2.astype(np.uint8) << 1)
            place = _place(one, np.zeros(1, np.int64), blocks)
            order = np.lexsort((two, one, place))
            one, two, flags, place = one[order], two[order], flags[order], place[order]
            first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            lists = [pack(one[i:j], [two[i:j]], flags[i:j]) for i, j in zip(first, np.r_[first[1:], len(one)])]
            kinds = np.full(len(first), _PAIRS)
            return pa.record_batch([pa.array(place[first], pa.int32()), pa.array(kinds, pa.int32()), pa.array(lists, pa.binary())], ["block", "kind", "data"])

        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= PIECE:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)

    return pairs.select(F.col("i1").cast("long").alias("i1"), F.col("i2").cast("long").alias("i2")).mapInArrow(packing, _ROW)


def _chunks(bundles: pa.ChunkedArray, parts: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """(group, id, value, flags) of the entries of whole groups, about a piece at a time, sorted by group and id.

    A group is whole in its bundle unless lists come in ``parts``.
    """

    def chunk(held) -> tuple[np.ndarray, ...]:
        group, ids, values, flags = (np.concatenate(c) for c in zip(*((np.repeat(g, size), *rest) for g, size, *rest in held)))
        order = np.lexsort((ids, group))
        return group[order], ids[order].astype(np.int64), values[order].astype(np.float64), flags[order]

    held, n = [], 0
    for packed in bundles:
        g, size, ids, (values,), flags = unpack_lists(packed.as_buffer(), 1)
        held.append((g, size, narrow(ids), narrow(values), flags))
        n += len(ids)
        if n >= PIECE and not parts:
            yield chunk(held)
            held, n = [], 0
    if held and parts and n > PIECE:
        g, size, ids, values, flags = (np.concatenate(c) for c in zip(*held))
        held, start = [], np.cumsum(size) - size
        order = np.argsort(g, kind="stable")
        g, size, start = g[order], size[order], start[order]
        ends, at = np.cumsum(size), 0
        while at < len(g):
            until = min(len(g) - 1, int(np.searchsorted(ends, ends[at] - size[at] + PIECE)))
            until = int(np.searchsorted(g, g[until], "right"))
            entry = spread_out(size[at:until], start[at:until])
            yield chunk([(g[at:until], size[at:until], ids[entry], values[entry], flags[entry])])
            at = until
    if held:
        yield chunk(held)


def _pieces(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of lines with about a piece of places."""
    ends, at = np.cumsum(n), 0
    while at < len(n):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at] - n[at]) + PIECE, "right")))
        yield at, until
        at = until


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[first], b[first]


class _Sums:
    """The sums of the distinct pairs asked in a block."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = np.unique(a), np.unique(b)
        self.keys = np.searchsorted(self.a, a) * len(self.b) + np.searchsorted(self.b, b)
        self.sums = np.zeros(len(a))
        self.first = np.searchsorted(self.keys, np.arange(len(self.a) + 1) * len(self.b))

    def add(self, keys: np.ndarray, products: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        asked = self.keys[at] == keys
        self.sums += np.bincount(at[asked], products[asked], len(self.keys))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.sums[np.searchsorted(self.keys, np.searchsorted(self.a, a) * len(self.b) + np.searchsorted(self.b, b))]

    def add_lists(self, group: np.ndarray, ids: np.ndarray, x: np.ndarray, flags: np.ndarray, large: int, roots: bool) -> None:
        """The products of each list's own items with its partners that somebody asks for."""
        with np.errstate(divide="ignore"):
            x = np.where(flags & NO_VALUE, 0.0, 1 / np.sqrt(x) if roots else x)
        mine = (flags & OWN > 0) & (ids != NULL_ID)
        code = np.minimum(np.searchsorted(self.a, ids), len(self.a) - 1)
        mine &= self.a[code] == ids
        a, own_x, own_group = code[mine], x[mine], group[mine]
        size = np.searchsorted(group, own_group, "right") - np.searchsorted(group, own_group)
        code = np.minimum(np.searchsorted(self.b, ids), len(self.b) - 1)
        known = (self.b[code] == ids) & (ids != NULL_ID)
        group, b, x = group[known], code[known], x[known]
        # Where a long list meets an item with few pairs, the pairs are looked up in the list.
        looked_up = (size > large) & (np.diff(self.first)[a] < size)
        low = np.searchsorted(group, own_group)
        n = np.searchsorted(group, own_group, "right") - low
        for some, start, n in ((~looked_up, low, n), (looked_up, self.first[a], np.diff(self.first)[a])):
            line = np.flatnonzero(some)
            for i, j in _pieces(n[line]):
                own, place = _expanded(n[line[i:j]])
                own = line[i:j][own]
                place = place + start[own]
                if some is looked_up:
                    # Entries of one group and item stand together; their values add up.
                    names, name = np.unique(group, return_inverse=True)
                    entry = name * len(self.b) + b
                    total = np.r_[0.0, np.cumsum(x)]
                    want = np.minimum(np.searchsorted(names, own_group[own]), max(len(names) - 1, 0))
                    there = names[want] == own_group[own] if len(names) else np.zeros(len(own), bool)
                    want = want * len(self.b) + self.keys[place] % len(self.b)
                    left, right = np.searchsorted(entry, want), np.searchsorted(entry, want, "right")
                    there &= right > left
                    value = total[right[there]] - total[left[there]] if (right - left > 1).any() else x[left[there]]
                    self.add(self.keys[place[there]], own_x[own[there]] * value)
                else:
                    self.add(a[own] * len(self.b) + b[place], own_x[own] * x[place])


def _block(blocks: int, hot, large: int, roots: bool, upwards: bool, lists_out: Callable | None, parts: tuple[bool, bool]):
    """Function of the rows of a block: the pairs asked in it with their sums, or what ``lists_out`` makes of each list's sums."""

    def mine(ids, group, block):
        part = (_mix(group) & 0x7FFFFFFFFFFFFFFF) % _parts(ids, hot)
        return _place(ids, part, blocks) == block

    def met(listed, block):
        """The pairs of each list: (group, value of a, a, b), a piece at a time."""
        for group, ids, x, flags in _chunks(listed, parts[1]):
            own = (flags & OWN > 0) & mine(ids, group, block)
            partner = flags & PARTNER > 0
            a, ag, ax, aflags, bg, b = ids[own], group[own], x[own], flags[own], group[partner], ids[partner]
            # An item that a list names twice as an a is one.
            first = np.ones(len(a), bool)
            if not upwards:
                first[1:] = (ag[1:] != ag[:-1]) | (a[1:] != a[:-1])
            a, ag, ax, aflags = a[first], ag[first], ax[first], aflags[first]
            low, high = np.searchsorted(bg, ag), np.searchsorted(bg, ag, "right")
            for i, j in _pieces(high - low):
                line, place = _expanded((high - low)[i:j])
                line = line + i
                other = b[low[line] + place]
                if upwards:
                    kept = (other > a[line]) & (a[line] != NULL_ID)
                    line, other = line[kept], other[kept]
                else:
                    # A null stands for the item it is paired with.
                    other = np.where(other == NULL_ID, a[line], other)
                yield ag, ax, aflags, a, line, other

    def work(rows: pa.Table) -> pa.Table:
        block = rows["block"][0].as_py()
        kind = rows["kind"].to_numpy()
        given, listed, pairs = (rows["data"].filter(pa.array(kind == k)) for k in (_MATRIX, _LISTS, _PAIRS))
        asked_a, asked_b, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        flags = []
        for packed in pairs:
            one, two, nulls = unpack(packed.as_py(), 1)
            asked_a.append(one)
            asked_b.append(np.ascontiguousarray(two[0]).view(np.int64))
            flags.append(nulls)
        if lists_out is None:
            all_a, all_b, flags = np.concatenate(asked_a), np.concatenate(asked_b), np.concatenate([np.zeros(0, np.uint8), *flags])
            asked_a, asked_b = [all_a], [all_b]
        else:
            for *_, a, line, other in met(listed, block):
                asked_a.append(a[line])
                asked_b.append(other)
                held += len(line)
                if held > 4 * PIECE:
                    a, b = _distinct(np.concatenate(asked_a), np.concatenate(asked_b))
                    asked_a, asked_b, held = [a], [b], 0
        sums = _Sums(*_distinct(np.concatenate(asked_a), np.concatenate(asked_b)))
        if len(sums.keys):
            for chunk in _chunks(given, parts[0]):
                sums.add_lists(*chunk, large, roots)
        if lists_out is None:
            shared = np.zeros(0) if not len(all_a) else sums.of(all_a, all_b)
            # Nothing meets a pair of nulls.
            shared = np.where(flags == 3, 0.0, shared)
            return pa.table({"i1": pa.array(all_a, mask=flags & 1 > 0), "i2": pa.array(all_b, mask=flags & 2 > 0), "shared": shared})
        found = []
        for ag, ax, aflags, a, line, other in met(listed, block):
            if not len(line):
                continue
            found.append(lists_out(ag, ax, aflags, a, line, other, sums.of(a[line], other)))
        empty = np.zeros(0, np.int64)
        return pa.concat_tables(found) if found else lists_out(empty, np.zeros(0), np.zeros(0, np.uint8), empty, empty, empty, np.zeros(0))

    return work


def _matrix(rows: DataFrame, group: str, item: str, value: str | None, left: str | None) -> DataFrame:
    x = F.lit(1.0) if value is None else F.col(value).cast("double")
    flags = F.lit(PARTNER | OWN) if left is None else F.when(F.col(left), PARTNER | OWN).otherwise(PARTNER)
    held = rows.filter(F.col(group).isNotNull() & F.col(item).isNotNull())
    return held.select(F.col(group).cast("long").alias("g"), F.col(item).cast("long").alias("b"), x.alias("x"), flags.cast("int").alias("flags"))


def _sizes(rows: DataFrame, group: str) -> tuple[float, int, float]:
    """(sum of the squares of the groups' sizes, the greatest size, the mean size)."""
    counts = rows.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    squares, longest, mean = counts.agg(F.sum(F.col("n").cast("double") * F.col("n")), F.max("n"), F.avg("n")).first()
    return squares or 0.0, longest or 0, mean or 0.0


_NO_HOT = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def asked_sums(rows: DataFrame, pairs: DataFrame, group: str, item: str, value: str | None, left: str | None, large: int, roots: bool = False, list_rows: int = LIST_ROWS) -> DataFrame:
    """``pairs`` (i1, i2; distinct) with ``shared``, the sum over common groups of value * value, 0 without one.

    ``rows`` (group, item, value) have whole numbers as ids; ``left`` marks those whose item occurs as an i1.
    With ``roots`` values are taken as 1 / sqrt(value): small numbers pack into fewer bytes than their roots.
    In groups of more than ``large`` rows the pairs of an item are looked up where they are fewer than the rows.
    """
    squares, longest, _ = _sizes(rows, group)
    blocks = int(min(2**20, squares / BLOCK_PRODUCTS + 1))
    given = _packed(_matrix(rows, group, item, value, left), _MATRIX, blocks, _NO_HOT, longest, list_rows)
    both = given.unionByName(_packed_pairs(pairs, blocks))
    return both.groupBy("block").applyInArrow(_block(blocks, _NO_HOT, large, roots, False, None, (longest > list_rows, False)), "i1 long, i2 long, shared double")


def list_sums(
    rows: DataFrame, lists: DataFrame, group: str, item: str, value: str, left: str | None, large: int, roots: bool, upwards: bool, out: Callable, schema: str, list_rows: int = LIST_ROWS
) -> DataFrame:
    """What ``out`` makes of the sums of the pairs (a, b) of each list.

    ``rows``, ``left`` and ``roots`` are as in ``asked_sums``. ``lists`` (g, b, x, flags) say which entries are a's and which b's (see ``OWN`` and ``PARTNER``). With
    ``upwards`` only pairs a < b are formed. ``out`` (groups, values, flags and ids of a's, then the line
    of its a, b and the sum for every pair) gives a table of ``schema``; the pairs of an a come together.
    """
    squares, longest, _ = _sizes(rows, group)
    sizes = lists.groupBy("g").agg(F.count_if(F.col("flags").bitwiseAND(OWN) > 0).cast("double").alias("a"), F.count_if(F.col("flags").bitwiseAND(PARTNER) > 0).cast("double").alias("b"))
    asked, longest_list, mean = sizes.agg(F.sum(F.col("a") * F.col("b")), F.max(F.col("a") + F.col("b")), F.sum("b") / F.sum(F.signum("b"))).first()
    blocks = int(min(2**20, (squares + (asked or 0.0)) / BLOCK_PRODUCTS + 1))
    # No more items than there are blocks' worths of pairs can be hot, so few are fetched.
    counts = lists.filter(F.col("flags").bitwiseAND(OWN) > 0).filter("b is not null").groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") * F.lit(mean or 0.0) / BLOCK_PRODUCTS).cast("long")
    found = counts.select("b", parts.alias("parts")).filter("parts > 1").orderBy("b").collect()
    hot = (np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], np.int64))
    given = _packed(_matrix(rows, group, item, value, left), _MATRIX, blocks, hot, longest, list_rows)
    wanted = _packed(lists, _LISTS, blocks, hot, longest_list or 0, list_rows)
    parts = (longest > list_rows, (longest_list or 0) > list_rows)
    return given.unionByName(wanted).groupBy("block").applyInArrow(_block(blocks, hot, large, roots, upwards, out, parts), schema)
