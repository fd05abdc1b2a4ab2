"""MinHash near-duplicates by a join of posted signature coordinates, confirmed on whole sets.

A document's set holds its distinct word shingles. Equal sets are one node. Of COORDINATES
permutations each node keeps the least hash, and posts itself under (coordinate, value). Sets of
the wanted similarity share at least ``match_threshold`` coordinates (but for one pair in 10 ** 9),
so a node need only post under its rarest COORDINATES - threshold + 1 values (prefix merging), and
of those the ones that nobody else has are skipped. Within a posting list coincidences are counted
over the whole signatures.

Counting only proposes: it cuts the nodes into groups that no link leaves. Then the whole sets of
a group meet once, and exact intersections decide. A group too large for a task is cut into slices
and each two of them meet in a task of their own. Neither step pairs out a group of near copies:
both grow trees of close nodes, as any chain of links gives the same classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import SPACED_TABLE, as_bytes, hashed_words, slices, stored, text_batches
from rankwell.llm.components import connected_components

WORDS, PERCENT = 2, 80
COORDINATES = 32
# Chance that a pair of exactly the wanted similarity shares fewer coordinates than asked for.
MISSED = 1e-9
SLICE_BYTES = 1_000_000
# Posting lists up to FEW compare all members at once; beyond LISTED all are proposed as one group.
FEW, LISTED = 8, 32_768
# Shingles of a group's slice; a task holds two slices.
TILE = 1_000_000
# The bitmap of nodes whose sets are needed has 16 bits a node, 2 ** MOST_BITS at most; a full one
# only lets more sets through to the join.
MOST_BITS = 27

_rng = np.random.default_rng(12)
_FLIPS = _rng.integers(0, 1 << 64, COORDINATES, np.uint64)
_TURNS = _rng.integers(0, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP, _SPREAD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)


def match_threshold(percent: int = PERCENT, missed: float = MISSED) -> int:
    """The most coordinates that two sets of that similarity share with a chance of 1 - missed."""
    p, below = percent / 100, 0.0
    for m in range(COORDINATES + 1):
        below += comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)
        if below > missed:
            return max(1, m)
    return COORDINATES


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of text i, sorted, are hashes[first[i]:first[i + 1]].

    A shingle is ``words`` consecutive words, or all words of a text with fewer.
    """
    hashes, owner, *_ = hashed_words(texts, SPACED_TABLE)
    counts = np.bincount(owner, minlength=len(texts))
    grams, owners = [], []
    with np.errstate(over="ignore"):
        for size in range(1, words + 1):
            n = max(0, len(hashes) - size + 1)
            out = np.zeros(n, np.uint64)
            for j in range(size):
                out = out * _STEP + hashes[j : j + n]
            out = (out ^ (out >> np.uint64(31))) * _SPREAD + np.uint64(size)
            out ^= out >> np.uint64(29)
            mine = owner[:n] == owner[size - 1 :]
            mine &= counts[owner[:n]] == size if size < words else True
            grams.append(out[mine]), owners.append(owner[:n][mine])
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of COORDINATES least hashes (int32) per text; zeros for empty sets."""
    out = np.zeros((len(first) - 1, COORDINATES), np.uint32)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        with np.errstate(over="ignore"):
            for j in range(COORDINATES):
                z = (hashes ^ _FLIPS[j]) * _TURNS[j]
                z = (z ^ (z >> np.uint64(32))) * _SPREAD
                out[full, j] = np.minimum.reduceat(z >> np.uint64(32), first[full])
    return out.view(np.int32)


def _digests(hashes: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    return [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:])]


def signed(docs: DataFrame, text: str, name: str, words: int = WORDS) -> DataFrame:
    """``docs`` with a struct of n_shingles (long), digest (of the set; null if empty) and signature."""
    text_batches(docs.sparkSession)

    def one(part: pa.Array) -> pa.Array:
        hashes, first = shingle_sets(part.to_pylist(), words)
        marks = pa.array(signatures(hashes, first).ravel())
        lists = pa.ListArray.from_arrays(np.arange(len(first), dtype=np.int32) * COORDINATES, marks)
        return pa.StructArray.from_arrays(
            [pa.array(np.diff(first)), pa.array(_digests(hashes, first), pa.binary()), lists], ["n_shingles", "digest", "signature"]
        )

    @F.arrow_udf("n_shingles long, digest binary, signature array<int>")
    def worked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [one(part) for _, part in slices(as_bytes(texts), SLICE_BYTES)]
            yield pa.concat_arrays(parts) if parts else one(pa.array([], pa.binary()))

    return docs.withColumn(name, worked(docs[f"`{text}`"]))


def _trees(nodes: np.ndarray, close) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever close pairs connect; ``close(i, rest)`` marks those close to i."""
    rest, ones, others = np.arange(len(nodes)), [nodes[:0]], [nodes[:0]]
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = close(at, rest)
            found, rest = rest[near], rest[~near]
            ones.append(np.full(len(found), nodes[at])), others.append(nodes[found])
            reached.extend(found)
    return np.concatenate(ones), np.concatenate(others)


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _proposals(matches: int):
    """Over (token, node, signature) sorted by token: trees of nodes that share ``matches`` coordinates."""

    def run(keys, nodes, marks) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(first, len(keys)))
        for at, n in zip(first[size > FEW].tolist(), size[size > FEW].tolist()):
            own = marks[at : at + n]
            yield _links(*_trees(nodes[at : at + n], lambda i, rest: (own[rest] == own[i]).sum(axis=1) >= matches))
        few = np.repeat(size <= FEW, size)
        keys, nodes, marks = keys[few], nodes[few], marks[few]
        for d in range(1, FEW):
            at = np.flatnonzero(keys[d:] == keys[:-d])
            if not len(at):
                break
            near = at[(marks[at] == marks[at + d]).sum(axis=1) >= matches]
            yield _links(nodes[near], nodes[near + d])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, marks = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, COORDINATES), np.int32)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            nodes = np.concatenate([nodes, batch.column(1).to_numpy()])
            marks = np.concatenate([marks, batch.column(2).flatten().to_numpy().reshape(-1, COORDINATES)])
            if len(keys):  # the last list may go on in the next batch
                whole = int(np.searchsorted(keys, keys[-1], "left"))
                if whole:
                    yield from run(keys[:whole], nodes[:whole], marks[:whole])
                keys, nodes, marks = keys[whole:], nodes[whole:], marks[whole:]
        if len(keys):
            yield from run(keys, nodes, marks)

    return scan


def proposed(nodes: DataFrame, matches: int, listed: int = LISTED) -> DataFrame:
    """(a, b): trees over ``nodes`` (node long, signature) that no pair with ``matches`` equal coordinates leaves.

    Lists of more than ``listed`` members are not compared: all are proposed together.
    """
    value = F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)
    posted = nodes.select("node", F.posexplode("signature").alias("at", "value"))
    tokens = posted.select("node", F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(value).alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Values that only this node has come first in the order by rarity and take up its prefix.
    shared = F.array_sort(F.collect_list(F.struct("n", "token")))
    prefix = COORDINATES - matches + 1
    # Spark takes exploded rows for as many as before, and an array for one entry: neither may be broadcast by that size.
    own = tokens.join(counts.hint("merge"), "token").groupBy("node").agg(shared.alias("shared"))
    left = F.greatest(F.lit(0), F.size("shared") - (COORDINATES - prefix))
    own = own.select("node", F.slice("shared", F.lit(1), left).alias("shared")).filter(F.size("shared") > 0)
    posts = stored(own.join(nodes.select("node", "signature").hint("merge"), "node").select("node", "signature", F.explode("shared").alias("s")).select("s.token", "s.n", "node", "signature"))
    short = posts.filter(F.col("n") <= listed).select("token", "node", "signature")
    trees = short.repartition("token").sortWithinPartitions("token").mapInArrow(_proposals(matches), "a long, b long")
    long = posts.filter(F.col("n") > listed).select("token", "node")
    heads = long.groupBy("token").agg(F.min("node").alias("a"))
    stars = long.join(heads, "token").filter("node <> a").select("a", F.col("node").alias("b"))
    return trees.union(stars).distinct()


def _bitmap(nodes: DataFrame) -> tuple[bytes, int]:
    """A bitmap with a bit for each digest of ``nodes``, and how many leading bits choose it."""
    bits = min(MOST_BITS, max(6, (16 * nodes.count()).bit_length()))
    head = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    bit = F.shiftright(head, 32 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    words = nodes.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.astype("<i8").tobytes(), bits


def _needed_sets(docs: DataFrame, text: str, nodes: DataFrame, words: int) -> DataFrame:
    """(digest, shingles binary) of every node, once, worked out from the texts again; maybe others."""
    bitmap, bits = _bitmap(nodes)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask, sent = np.frombuffer(shared.value, np.uint8), set()
        for batch in batches:
            for _, part in slices(as_bytes(batch.column(0)), SLICE_BYTES):
                hashes, first = shingle_sets(part.to_pylist(), words)
                keys, sets = [], []
                for i, digest in enumerate(_digests(hashes, first)):
                    if digest is None or digest in sent:
                        continue
                    bit = int.from_bytes(digest[:4], "big") >> (32 - bits)
                    if mask[bit >> 3] >> (bit & 7) & 1:
                        sent.add(digest)
                        keys.append(digest), sets.append(hashes[first[i] : first[i + 1]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["digest", "shingles"])

    return docs.select(f"`{text}`").mapInArrow(found, "digest binary, shingles binary")


def _confirmed(percent: int):
    """Of a tile's nodes with their sets: trees of links, each confirmed on the whole sets."""

    def work(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        nodes, at = np.unique(tile["node"].to_numpy(), return_index=True)
        sets = tile["shingles"].take(pa.array(at))
        size = np.array([len(s.as_py()) // 8 for s in sets])
        hashes = np.frombuffer(b"".join(s.as_py() for s in sets), np.uint64)
        code = np.unique(hashes, return_inverse=True)[1]
        first = np.concatenate([[0], np.cumsum(size)])
        owner = np.repeat(np.arange(len(nodes)), size)
        mark = np.zeros(code.max(initial=0) + 1, bool)
        held = {"code": code, "owner": owner, "rest": len(nodes)}

        def close(i, rest):
            # Nodes already reached are never asked for again, so their shingles go in time.
            if 2 * len(rest) < held["rest"]:
                stay = np.isin(held["owner"], rest)
                held.update(code=held["code"][stay], owner=held["owner"][stay], rest=len(rest))
            mine = code[first[i] : first[i + 1]]
            mark[mine] = True
            both = np.bincount(held["owner"][mark[held["code"]]], minlength=len(nodes))[rest]
            mark[mine] = False
            return 100 * both >= percent * (size[i] + size[rest] - both)

        return pa.Table.from_batches([_links(*_trees(nodes, close))])

    return work


def links(docs: DataFrame, text: str, nodes: DataFrame, words: int = WORDS, percent: int = PERCENT, tile: int = TILE, listed: int = LISTED) -> DataFrame:
    """(a, b): confirmed links that connect all ``nodes`` (node, digest, n_shingles, signature) whose sets are similar."""
    groups = connected_components(proposed(nodes.select("node", "signature"), match_threshold(percent), listed))
    held = groups.join(nodes.select("node", "digest", "n_shingles"), "node")
    weights = held.groupBy("component").agg(F.ceil(F.sum("n_shingles") / tile).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    held = stored(held.join(weights, "component").select("node", "digest", "component", "parts", mine.alias("slice")))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda s: (s != F.col("slice")) | (F.col("parts") == 1))
    tiles = held.select("node", "digest", "component", "slice", F.explode(others).alias("other"))
    tiles = tiles.select("node", "digest", "component", F.least("slice", "other").alias("low"), F.greatest("slice", "other").alias("high"))
    sets = _needed_sets(docs, text, held.select("digest"), words).dropDuplicates(["digest"])
    # A tile's rows are exploded too: no broadcast of what Spark takes for the slices alone.
    met = tiles.join(sets.hint("merge"), "digest").select("component", "low", "high", "node", "shingles")
    return met.groupBy("component", "low", "high").applyInArrow(_confirmed(percent), "a long, b long").distinct()


def components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    tile: int = TILE,
    listed: int = LISTED,
) -> DataFrame:
    """(id, n_shingles, component_id, kept): near-duplicate classes of all rows.

    A-Z are lower-cased, words are cut at ASCII white space. Documents link where the shared
    shingles are ``percent`` of 100 or more of all of both; equal sets always do. component_id is
    the smallest id reachable (nulls ignored), kept whether it is the row's own. Texts without a
    word, and null, have empty sets, are linked with nothing and kept. Rows without id take part;
    they are kept where no row of their class has one. Repeated ids keep a row each. An empty
    table gives no rows. Sets are told apart by 128-bit digests of 64-bit shingle hashes.
    """
    chosen = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    marked = signed(chosen, "text", "m", words).select("id", F.monotonically_increasing_id().alias("row"), "m.*")
    marked = stored(marked)
    full = marked.filter("n_shingles > 0")
    nodes = stored(full.groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))
    found = connected_components(links(chosen, "text", nodes, words, percent, tile, listed))
    named = nodes.join(found, nodes.node == found.node, "left").select("digest", "first", F.coalesce("component", nodes.node).alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("digest", "component_id")
    out = marked.select("id", "n_shingles", "digest").join(named, "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    kept = F.coalesce(F.col("id") == own, own.isNull())
    return out.select(F.col("id").alias(id_col), "n_shingles", own.alias("component_id"), kept.alias("kept"))


ORACLE_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) < {WORDS} THEN [ws[1]] ELSE [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))] END) AS s
    FROM d WHERE len(ws) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
sized AS MATERIALIZED (SELECT * FROM sets JOIN sizes USING (doc_id)),
met AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS shared
  FROM sized a JOIN sized b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY 1, 2, 3, 4),
links AS MATERIALIZED (SELECT a, b FROM met WHERE 100 * shared >= {PERCENT} * (na + nb - shared)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.doc_id, w.b FROM reached r JOIN ways w ON w.a = r.other)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id, d.doc_id = least_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS least_id FROM reached GROUP BY 1) USING (doc_id)
"""
