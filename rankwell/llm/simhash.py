"""SimHash near-duplicates: fingerprints that differ in few bits, found by ball hashing.

Two fingerprints within the radius meet in the middle: some value lies within half the radius
of both. Emitting the whole ball of radius 2 around a 64-bit fingerprint takes 2,081 rows, so
fingerprints are first cut in two: of at most four differing bits one half has at most two,
and there the balls of radius 1 (33 rows a half) must meet. Pairs that meet are verified over
all 64 bits. Fingerprints that share a value are not paired out: a forest of verified links
connects them. If more share one than a task should compare, they emit their whole balls
instead, where any two that meet are linked, so links to the least one replace comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import as_bytes, fresh, slices, stored, text_batches
from rankwell.llm.components import connected_components

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
# Shingles turned into bits at once.
STEP = 50_000
SLICE_BYTES = 1_000_000
# Members that meet in one value: up to FEW all close pairs are links, up to PAIRED a forest of
# close pairs that connects them; only beyond that whole balls take over.
FEW, PAIRED = 8, 2048


def _digests(text: bytes) -> Iterator[tuple[bytes, int]]:
    """Hashes of a text's shingles in pieces of at most STEP: (8 bytes each, how many)."""
    words = text.lower().split()
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= SHINGLE:
        yield digest(joined, SEED), 1
        return
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = len(words) - SHINGLE + 1
    for at in range(0, n, STEP):
        to = min(n, at + STEP)
        cuts = zip(starts[at:to], ends[at + SHINGLE - 1 : to + SHINGLE - 1])
        yield b"".join([digest(joined[a:b], SEED) for a, b in cuts]), to - at


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    """Fingerprints of a binary array of texts, as signed 64-bit integers."""
    ones, total = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    held: list[bytes] = []
    owners: list[int] = []
    counts: list[int] = []

    def fold() -> None:
        if held:
            bits = np.unpackbits(np.frombuffer(b"".join(held), np.uint8).reshape(-1, 8), axis=1)
            first = np.concatenate([[0], np.cumsum(counts)[:-1]])
            np.add.at(ones, owners, np.add.reduceat(bits, first, axis=0, dtype=np.int32))
            np.add.at(total, owners, counts)
            held.clear(), owners.clear(), counts.clear()

    waiting = 0
    for i, text in enumerate(texts.to_pylist()):
        for digests, n in _digests(text):
            held.append(digests), owners.append(i), counts.append(n)
            waiting += n
            if waiting >= STEP:
                fold()
                waiting = 0
    fold()
    return np.packbits(2 * ones > total[:, None], axis=1).reshape(-1, 8).view(">i8").ravel().astype(np.int64)


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with a 64-bit SimHash (long) of the 4-word shingles of each whole text.

    A-Z are lower-cased, words are cut at ASCII white space, repeated shingles count each time.
    Shorter texts have one shingle; texts without words, and null, have fingerprint 0.
    """

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [fingerprints_of(part) for _, part in slices(as_bytes(texts), SLICE_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))

    text_batches(docs.sparkSession)
    return docs.withColumn(name, simhash(docs[f"`{text}`"]))


def ball(bits: int, radius: int) -> list[int]:
    """Every mask of ``bits`` bits with at most ``radius`` ones."""
    return [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def half_balls(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(key, fp): for each half of ``fp`` the values within half of its share of the radius."""
    masks = ball(BITS // 2, -(-(radius // 2) // 2))
    low, high = F.col("fp").bitwiseAND((1 << 32) - 1), F.shiftrightunsigned("fp", 32)
    keys = [F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"), "fp"]
    spread = prints.select(*keys)
    return spread.select(
        F.explode(
            F.array(low.bitwiseXOR(F.col("mask")), high.bitwiseXOR(F.col("mask")).bitwiseOR(F.lit(1 << 32)))
        ).alias("key"),
        "fp",
    )


def whole_balls(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(key, fp): all values within half the radius of the whole ``fp``."""
    masks = F.array(*[F.lit(_signed(m)) for m in ball(BITS, radius // 2)])
    return prints.select("fp", F.explode(masks).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("key"), "fp")


def _batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _verified(radius: int, paired: int):
    """Over rows sorted by key: links within each run, or (fp, fp) for the members of a long run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        crowded = None  # key of the run now open, if it is known to be long
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy()])
            if not len(keys):
                continue
            # The last run stays open, but for what is known to belong to a long one.
            open_at = int(np.searchsorted(keys, keys[-1], "left"))
            for out in _runs(keys[:open_at], prints[:open_at], radius, paired, crowded):
                yield out
            crowded = crowded if crowded == keys[-1] else None
            keys, prints = keys[open_at:], prints[open_at:]
            if crowded is not None or len(keys) > paired:
                crowded = keys[-1]
                yield _batch(prints, prints)
                keys, prints = keys[:0], prints[:0]
        for out in _runs(keys, prints, radius, paired, crowded):
            yield out

    return run


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs that connect whatever close pairs of ``prints`` connect; fewer than members."""
    left, ones, others = np.unique(prints), [], []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            one = reached.pop()
            near = _apart(left, one) <= radius
            found, left = left[near], left[~near]
            ones.append(np.full(len(found), one)), others.append(found)
            reached.extend(found)
    a, b = np.concatenate([np.zeros(0, np.int64), *ones]), np.concatenate([np.zeros(0, np.int64), *others])
    return np.minimum(a, b), np.maximum(a, b)


def _runs(keys, prints, radius, paired, crowded) -> Iterator[pa.RecordBatch]:
    if not len(keys):
        return
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    long = np.repeat((size > paired) | ((keys[first] == crowded) if crowded is not None else False), size)
    if long.any():
        yield _batch(prints[long], prints[long])
        keys, prints = keys[~long], prints[~long]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else first[:0]
        size = np.diff(np.append(first, len(keys)))
    more = size > FEW
    if more.any():
        forests = [_forest(prints[at : at + n], radius) for at, n in zip(first[more].tolist(), size[more].tolist())]
        yield _batch(*(np.concatenate(side) for side in zip(*forests)))
        few = ~np.repeat(more, size)
        keys, prints = keys[few], prints[few]
    for d in range(1, FEW):
        at = np.flatnonzero(keys[d:] == keys[:-d])
        if not len(at):
            break
        a, b = prints[at], prints[at + d]
        near = _apart(a, b) <= radius
        yield _batch(np.minimum(a[near], b[near]), np.maximum(a[near], b[near]))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (key, fp): each fp linked to the first of its run."""
    key, head = None, 0
    for batch in batches:
        keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        first = np.flatnonzero(np.concatenate([[keys[0] != key], keys[1:] != keys[:-1]]))
        heads = np.full(len(keys), head)
        run = np.searchsorted(first, np.arange(len(keys)), "right") - 1
        heads[run >= 0] = prints[first[run[run >= 0]]]
        key, head = keys[-1], heads[-1]
        other = heads != prints
        yield _batch(heads[other], prints[other])


def near_links(prints: DataFrame, radius: int = RADIUS, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) that connect all of ``prints`` (fp long, distinct) within ``radius`` bits.

    Every link is between fingerprints within the radius, and any two such fingerprints are
    connected by links. An odd radius raises ValueError: two balls of half of it need not meet.
    """
    if radius % 2:
        raise ValueError(f"radius {radius} is odd")
    met = half_balls(prints, radius)
    met = met.repartition("key").sortWithinPartitions("key").mapInArrow(_verified(radius, paired), "a long, b long")
    met = stored(met.distinct())
    crowded = met.filter("a = b").select(F.col("a").alias("fp"))
    balls = whole_balls(crowded, radius).repartition("key").sortWithinPartitions("key", "fp")
    chained = balls.mapInArrow(_chained, "a long, b long").distinct()
    return met.filter("a <> b").union(chained)


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", paired: int = PAIRED) -> DataFrame:
    """(id, fingerprint long, component_id, component): near-duplicate classes of all rows.

    Fingerprints link at ``RADIUS`` or fewer differing bits; component_id is the smallest id
    reachable (nulls ignored; null if there is no other), component the class itself. Equal
    fingerprints are one node, so copies cost one row each. Repeated ids keep a row each.
    """
    return classes(stored(fingerprints(docs.select(id_col, text), text).select(id_col, "fingerprint")), id_col, paired)


def classes(marked: DataFrame, id_col: str = "doc_id", paired: int = PAIRED) -> DataFrame:
    """``marked`` (with a fingerprint column) with component_id and component; see ``components``."""
    nodes = stored(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_col).alias("first")))
    found = connected_components(near_links(nodes.select("fp"), paired=paired))
    named = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(named.join(least, "component").select(F.col("fp").alias("fingerprint"), "component_id", "component"))
    return marked.join(named, "fingerprint")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate class, that with the smallest id; columns as they were.

    Of rows with the same smallest id one stays; ids that are null come last.
    """
    row, mark = fresh(docs, "__row"), fresh(docs, "fingerprint")
    held = docs.withColumn(row, F.monotonically_increasing_id())
    held = stored(fingerprints(held, text, mark))
    small = held.select(F.col(f"`{id_col}`").alias("id"), F.col(row).alias("row"), F.col(mark).alias("fingerprint"))
    order = F.struct(F.col("id").isNull(), "id", "row")
    kept = classes(small, "id").groupBy("component").agg(F.min(order).alias("o")).select(F.col("o.row").alias(row))
    return held.join(kept, row, "left_semi").select(*[held[f"`{c}`"] for c in docs.columns])
