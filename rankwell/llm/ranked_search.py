"""Ranked lexical search over per-term geometric blocks.

A document is a vector of impacts, one per term. Vectors are clustered: a cell holds vectors near
the same centre and on the same sides of random planes, or a share of them where they are many, so
each term's posting list falls into blocks of similar documents, one per cell. A block keeps the
coordinatewise maximum of its vectors. For an item that has the block's term, the sum of the
maxima over the item's terms bounds the score of every document in the block. The cells with the
best bounds are scored first and give each item a score that its k-th document reaches; a block
whose bound is below it is skipped, and documents of all other blocks are scored exactly.

Items are searched in batches, so what is broadcast (their terms, and which terms an item has in
common) stays within ``BATCH_TERMS`` item terms, or one item where that has more. Only the terms
of the batch's items are indexed, and a block keeps those coordinates that share an item with its
term; all documents are. Documents with equal vectors are one vector with their ``k`` least ids,
of which more can never be among the best ``k``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwell.llm.common import as_bytes, hashed_words, slices, stored, text_batches
from rankwell.skew import top_rows

K = 10
SLICE_BYTES = 1_000_000
BATCH_TERMS = 500_000
# Terms of an item whose blocks bound it together; for the item's other terms they use the cell's maxima.
PART = 256
# Vectors and entries of a cell.
CELL_DOCS, CELL_ENTRIES = 512, 60_000
# Vectors are compared as sketches of so many numbers, with at most so many centres, which are
# a sample: the vectors of least digest.
SKETCH, CENTRES = 256, 1024
# Cells scored first for each item.
SEEDS = 8
# Entries of a dense matrix in a task.
DENSE = 4_000_000

VECTOR = "n long, key binary, terms array<int>, tfs array<int>"


@dataclass
class Items:
    """A batch of items: the sorted hashes of their terms, and each item's places among them."""

    rows: np.ndarray
    vocabulary: np.ndarray  # uint64
    first: np.ndarray
    terms: np.ndarray
    # Which coordinates a term's blocks keep: sorted pairs (term, coordinate), and the items each is for.
    pair_term: np.ndarray
    pair_other: np.ndarray
    pair_first: np.ndarray
    pair_items: np.ndarray
    # Coordinates from len(vocabulary) on stand for the rest of a long item: (its terms, without these).
    rests: list[tuple[np.ndarray, np.ndarray]]

    def of(self, item: int) -> np.ndarray:
        return self.terms[self.first[item] : self.first[item + 1]]


def _batch(rows: np.ndarray, lists: list[np.ndarray], part: int) -> Items:
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists]))
    places = [np.searchsorted(vocabulary, t) for t in lists]
    rests: list[tuple[np.ndarray, np.ndarray]] = []
    term, other, item = [], [], []
    for q, own in enumerate(places):
        for at in range(0, len(own), part):
            mine = own[at : at + part]
            coordinates = mine
            if len(own) > part:
                coordinates = np.append(mine, len(vocabulary) + len(rests))
                rests.append((own, mine))
            term.append(np.repeat(mine, len(coordinates)))
            other.append(np.tile(coordinates, len(mine)))
            item.append(np.full(len(mine) * len(coordinates), q))
    term, other, item = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (term, other, item))
    order = np.lexsort((item, other, term))
    term, other, item = term[order], other[order], item[order]
    new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (other[1:] != other[:-1])])) if len(term) else np.zeros(0, np.int64)
    first = np.cumsum([0, *map(len, places)])
    flat = np.concatenate([np.zeros(0, np.int64), *places])
    return Items(rows, vocabulary, first, flat, term[new], other[new], np.append(new, len(term)), item, rests)


def item_terms(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, terms array of long): hashes of the distinct terms of every item, numbered."""
    text_batches(items.sparkSession)

    @F.arrow_udf("array<long>")
    def worked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            hashes, owner, *_ = hashed_words(as_bytes(texts).to_pylist())
            own = [np.unique(hashes[owner == i]).view(np.int64) for i in range(len(texts))]
            yield pa.array(own, pa.list_(pa.int64()))

    chosen = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    return chosen.select(F.monotonically_increasing_id().alias("item"), "item_id", worked("text").alias("terms"))


def vectors(docs: DataFrame, id_col: str, text: str, vocabulary: np.ndarray) -> DataFrame:
    """(id, n, key, terms, tfs): all terms counted, and those of ``vocabulary`` with their counts.

    key is a digest of n, terms and tfs. Terms are told apart by 64-bit hashes.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def one(texts: list[bytes]) -> pa.Array:
        words = shared.value
        hashes, owner, *_ = hashed_words(texts)
        n = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        known = words[at] == hashes
        code, tf = np.unique(owner[known] * len(words) + at[known], return_counts=True)
        term, tf = (code % len(words)).astype(np.int32), tf.astype(np.int32)
        first = np.searchsorted(code // len(words), np.arange(len(texts) + 1)).astype(np.int32)
        keys = [
            hashlib.blake2b(m.tobytes() + term[a:b].tobytes() + tf[a:b].tobytes(), digest_size=16).digest()
            for m, a, b in zip(n, first[:-1], first[1:])
        ]
        lists = [pa.ListArray.from_arrays(first, pa.array(x)) for x in (term, tf)]
        return pa.StructArray.from_arrays([pa.array(n), pa.array(keys, pa.binary()), *lists], ["n", "key", "terms", "tfs"])

    @F.arrow_udf(VECTOR)
    def worked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [one(part.to_pylist()) for _, part in slices(as_bytes(texts), SLICE_BYTES)]
            yield pa.concat_arrays(parts) if parts else one([])

    return docs.select(F.col(f"`{id_col}`").alias("id"), worked(docs[f"`{text}`"]).alias("v")).select("id", "v.*")


@dataclass
class Weights:
    """What turns counts into impacts: documents with a term, all their terms, and a weight per term."""

    n: int
    total: int
    weight: np.ndarray

    def impacts(self, n: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        tf = tfs.astype(np.int64)
        m = 10 + (90 * n * self.n) // self.total
        return self.weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def weights(marked: DataFrame, vocabulary: np.ndarray) -> Weights | None:
    """Counts over all documents; the driver gets one number per term of the batch."""
    sizes = marked.filter("n > 0").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
    if not sizes["n"]:
        return None
    found = marked.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(len(vocabulary), np.int64)
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    weight = [math.floor(1000 * math.log((2 * sizes["n"] + 2) / (2 * d + 1))) for d in df.tolist()]
    return Weights(sizes["n"], sizes["total"], np.array(weight, np.int64))


def _entries(n: pa.Array, terms: pa.Array, tfs: pa.Array):
    """(vector of each entry, n of each entry, term, tf) of list columns."""
    size = np.diff(terms.offsets.to_numpy())
    owner = np.repeat(np.arange(len(terms)), size)
    return owner, n.to_numpy()[owner], terms.flatten().to_numpy(), tfs.flatten().to_numpy()


def _sketches(owner, terms, impacts, rows: int) -> np.ndarray:
    """Impacts' roots added up by hashed term, with signs, as unit vectors."""
    mixed = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sign = 1 - 2 * ((mixed >> np.uint64(20)) & np.uint64(1)).astype(np.int64)
    at = owner * SKETCH + ((mixed >> np.uint64(32)) % np.uint64(SKETCH)).astype(np.int64)
    out = np.bincount(at, sign * np.sqrt(impacts), rows * SKETCH).reshape(rows, SKETCH)
    return out / np.maximum(np.sqrt(np.square(out).sum(axis=1, keepdims=True)), 1e-9)


def cells(marked: DataFrame, weight: Weights, k: int, cell_docs: int = CELL_DOCS) -> DataFrame:
    """(cell, docs array of struct ids, n, terms, tfs): all vectors with a term, clustered.

    Vectors are equal where their digests are; ids are the ``k`` least ids of such a vector.
    """
    known = marked.filter((F.size("terms") > 0) & F.col("id").isNotNull())
    ids = top_rows(known.select("key", "id"), "key", [F.asc("id")], k)
    ids = ids.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    single = known.groupBy("key").agg(*[F.first(c).alias(c) for c in ("n", "terms", "tfs")])
    single = stored(single.join(ids, "key"))

    @F.arrow_udf("array<float>")
    def sketch(n: pa.Array, terms: pa.Array, tfs: pa.Array) -> pa.Array:
        owner, length, term, tf = _entries(n, terms, tfs)
        out = _sketches(owner, term, weight.impacts(length, term, tf), len(n))
        return pa.array(list(out.astype(np.float32)), pa.list_(pa.float32()))

    many = max(1, math.ceil(single.count() / cell_docs))
    chosen = single.orderBy("key").limit(min(CENTRES, many)).select(sketch("n", "terms", "tfs").alias("s")).collect()
    centres = np.array([r.s for r in chosen], np.float32).reshape(-1, SKETCH)
    sides = max(0, math.ceil(math.log2(many / max(1, len(centres)))))
    planes = np.random.default_rng(11).standard_normal((SKETCH, sides)).astype(np.float32)

    @F.arrow_udf("long")
    def place(n: pa.Array, terms: pa.Array, tfs: pa.Array) -> pa.Array:
        owner, length, term, tf = _entries(n, terms, tfs)
        own = _sketches(owner, term, weight.impacts(length, term, tf), len(n)).astype(np.float32)
        near = (own @ centres.T).argmax(axis=1)
        side = ((own - centres[near]) @ planes > 0) @ (1 << np.arange(sides)) if sides else np.zeros(len(own), np.int64)
        return pa.array(near.astype(np.int64) << 32 | side.astype(np.int64))

    placed = stored(single.withColumn("place", place("n", "terms", "tfs"))) if len(centres) else single.withColumn("place", F.lit(0).cast("long"))
    sizes = placed.groupBy("place").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("terms")).alias("entries"))
    parts = F.ceil(F.greatest(F.col("docs") / cell_docs, F.col("entries") / CELL_ENTRIES)).cast("int")
    cut = placed.join(sizes.select("place", parts.alias("parts")), "place")
    cut = cut.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    packed = cut.groupBy("place", "part").agg(F.collect_list(F.struct("ids", "n", "terms", "tfs")).alias("docs"))
    # Cells are small to read and dear to work on, so they are dealt over more tasks than their bytes ask for.
    tasks = max(int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions")), many // 32)
    return stored(packed.select((F.shiftleft("place", 20) + F.col("part")).alias("cell"), "docs").repartition(tasks, "cell"))


def _cell(docs: pa.Array, weight: Weights):
    """Vectors of a cell: the first entry of each, local term of each entry, impact, and the terms."""
    owner, n, term, tf = _entries(docs.field("n"), docs.field("terms"), docs.field("tfs"))
    terms, local = np.unique(term, return_inverse=True)
    return np.searchsorted(owner, np.arange(len(docs) + 1)), local, weight.impacts(n, term, tf), terms


def _maxima(first, local, impact, terms, items: Items, dense: int) -> tuple[np.ndarray, np.ndarray]:
    """(places among the batch's pairs, maxima above 0) of the blocks of one cell."""
    size = len(items.vocabulary)
    where = np.full(size + len(items.rests), -1)
    where[terms] = np.arange(len(terms))
    pairs = np.flatnonzero((where[items.pair_term] >= 0) & ((where[items.pair_other] >= 0) | (items.pair_other >= size)))
    plain = items.pair_other[pairs] < size
    t, u = where[items.pair_term[pairs[plain]]], where[items.pair_other[pairs[plain]]]
    best = np.zeros(len(t), np.int64)
    square = np.diff(first) ** 2 <= max(len(t), 1)
    step = max(1, dense // max(1, len(terms)))
    own = [(local[a:b], impact[a:b]) for a, b in zip(first[:-1], first[1:])]
    for low in range(0, len(terms) if len(t) else 0, step):
        # Of vectors with few entries all pairs of entries, rows of so many terms at a time.
        block = np.zeros((min(step, len(terms) - low), len(terms)), np.int64)
        for d in np.flatnonzero(square).tolist():
            at, x = own[d]
            mine = at[np.searchsorted(at, low) : np.searchsorted(at, low + step)] - low
            if len(mine):
                place = np.ix_(mine, at)
                block[place] = np.maximum(block[place], x)
        inside = (t >= low) & (t < low + step)
        best[inside] = block[t[inside] - low, u[inside]]
    for d in np.flatnonzero(~square).tolist():
        # Of those with many entries the wanted pairs.
        x = np.zeros(len(terms), np.int64)
        x[own[d][0]] = own[d][1]
        best = np.maximum(best, np.where(x[t] > 0, x[u], 0))
    out = np.zeros(len(pairs), np.int64)
    out[plain] = best
    if items.rests:
        most = np.zeros(size, np.int64)
        np.maximum.at(most, terms[local], impact)
        rest = np.array([most[every].sum() - most[mine].sum() for every, mine in items.rests])
        out[~plain] = rest[items.pair_other[pairs[~plain]] - size]
    held = out > 0
    return pairs[held], out[held]


def blocks(packed: DataFrame, weight: Weights, items: Items, dense: int = DENSE) -> DataFrame:
    """(cell, term, coordinates, maxima): the summary of every block, zeros left out."""
    shared = packed.sparkSession.sparkContext.broadcast(items)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            docs = batch.column(1)
            for i, cell in enumerate(batch.column(0).to_pylist()):
                pairs, most = _maxima(*_cell(docs[i].values, weight), own, dense)
                term = own.pair_term[pairs]
                new = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
                ends = np.append(new, len(term)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (own.pair_other[pairs].astype(np.int32), most)]
                columns = [pa.array(np.full(len(new), cell)), pa.array(term[new].astype(np.int32)), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "term", "coordinates", "maxima"])

    return packed.mapInArrow(work, "cell long, term int, coordinates array<int>, maxima array<long>")


def bounds(summaries: DataFrame, items: Items) -> DataFrame:
    """(cell, item, term, bound): what no document of the block can exceed, for items with the block's term."""
    shared = summaries.sparkSession.sparkContext.broadcast(items)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        count, width = len(own.rows), len(own.vocabulary) + len(own.rests)
        codes = own.pair_term * width + own.pair_other
        for batch in batches:
            for at in range(0, batch.num_rows, step := max(1, DENSE // max(1, count))):
                cell, term, lists, maxima = (c for c in batch.slice(at, step).columns)
                row = np.repeat(np.arange(len(cell)), np.diff(lists.offsets.to_numpy()))
                pair = np.searchsorted(codes, term.to_numpy()[row].astype(np.int64) * width + lists.flatten().to_numpy())
                n = own.pair_first[pair + 1] - own.pair_first[pair]
                entry = np.repeat(np.arange(len(pair)), n)
                item = own.pair_items[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + own.pair_first[pair][entry]]
                total = np.bincount(row[entry] * count + item, maxima.flatten().to_numpy()[entry], len(cell) * count)
                found = np.flatnonzero(total)
                of = found // count
                columns = [cell.to_numpy()[of], (found % count).astype(np.int32), term.to_numpy()[of], total[found].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "item", "term", "bound"])

    return summaries.mapInArrow(work, "cell long, item int, term int, bound long")


def scored(packed: DataFrame, alive: DataFrame, weight: Weights, items: Items, least: np.ndarray, k: int) -> DataFrame:
    """(item, id, score): of each cell the ``k`` best documents per item with at least ``least[item]``.

    ``alive`` (cell, item, term) are the blocks to look into. A document that is also in another
    block of the item's terms has been bounded there, and is skipped with that block.
    """
    shared = packed.sparkSession.sparkContext.broadcast((items, least))
    asked = alive.groupBy("cell").agg(F.collect_list(F.struct("item", "term")).alias("asked"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, floor = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                docs, looked = batch.column(1)[i].values, batch.column(2)[i].values
                first, local, impact, terms = _cell(docs, weight)
                item, term = looked.field("item").to_numpy(), looked.field("term").to_numpy()
                asks = np.unique(item)
                place = np.full(len(own.vocabulary), -1)
                place[terms] = np.arange(len(terms))
                want, dead = np.zeros((len(terms), len(asks))), np.zeros((len(terms), len(asks)))
                for c, q in enumerate(asks.tolist()):
                    mine = place[own.of(q)]
                    want[mine[mine >= 0], c] = 1
                dead[:] = want
                dead[place[term], np.searchsorted(asks, item)] = 0
                ids = docs.field("ids")
                result = [[], [], []]
                step = max(1, DENSE // max(1, len(terms)))
                found = []
                for at in range(0, len(docs), step):
                    to = min(len(docs), at + step)
                    x = np.zeros((to - at, len(terms)))
                    rows = np.repeat(np.arange(to - at), np.diff(first[at : to + 1]))
                    x[rows, local[first[at] : first[to]]] = impact[first[at] : first[to]]
                    score = x @ want  # whole numbers far below 2 ** 53: exact
                    score[(x > 0).astype(np.float64) @ dead > 0] = 0
                    found.append(score)
                score = np.concatenate(found).astype(np.int64)
                for c, q in enumerate(asks.tolist()):
                    column = score[:, c]
                    best = max(int(floor[q]), 1)
                    if np.count_nonzero(column >= best) > k:
                        best = max(best, int(np.partition(column, -k)[-k]))
                    hits = np.flatnonzero(column >= best)
                    pairs = sorted((-int(column[h]), one) for h in hits.tolist() for one in ids[h].as_py())[:k]
                    result[0] += [q] * len(pairs)
                    result[1] += [p[1] for p in pairs]
                    result[2] += [-p[0] for p in pairs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(result[0], pa.int32()), pa.array(result[1], pa.int64()), pa.array(result[2], pa.int64())], ["item", "id", "score"]
                )

    return packed.join(asked, "cell").select("cell", "docs", "asked").mapInArrow(work, "item int, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    return top_rows(found, "item", [F.desc("score"), F.asc("id")], k)


def _searched(spark: SparkSession, docs: DataFrame, items: Items, id_col: str, text: str, k: int, cell_docs: int, seeds: int, dense: int):
    """(item place, id, score, rank) of one batch of items; None where no document has a term."""
    marked = stored(vectors(docs, id_col, text, items.vocabulary))
    weight = weights(marked, items.vocabulary)
    if weight is None:
        return None
    packed = cells(marked, weight, k, cell_docs)
    summaries = stored(blocks(packed, weight, items, dense))
    limits = stored(bounds(summaries, items))
    tops = limits.groupBy("cell", "item").agg(F.max("bound").alias("bound"))
    first = top_rows(tops, "item", [F.desc("bound"), F.asc("cell")], seeds).select("cell", "item")
    nothing = np.ones(len(items.rows), np.int64)
    early = _best(scored(packed, limits.join(first, ["cell", "item"], "left_semi"), weight, items, nothing, k), k)
    least = nothing.copy()
    for r in early.filter(F.col("rank") == k).select("item", "score").collect():  # one row an item of the batch
        least[r["item"]] = r["score"]
    floors = spark.createDataFrame(list(enumerate(least.tolist())), "item int, least long")
    alive = limits.join(F.broadcast(floors), "item").filter("bound >= least").select("cell", "item", "term")
    return _best(scored(packed, alive, weight, items, least, k), k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    batch_terms: int = BATCH_TERMS,
    part: int = PART,
    cell_docs: int = CELL_DOCS,
    seeds: int = SEEDS,
    dense: int = DENSE,
) -> DataFrame:
    """(item_id, rank int, id long, score long): the ``k`` best documents with a score above 0 of every item.

    Terms are words of letters, digits and non-ASCII characters, A-Z lower-cased. Equal scores go
    by id. Documents without a term, null and empty ones do not count; those without an id count
    in all statistics but are never listed. Repeated ids are documents of their own; repeated items
    and items without id have a list each; items without a known term have none, and so have all
    where either table is empty. Other columns take no part.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_id, item_text))
    total = asked.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    kind = dict(asked.dtypes)["item_id"]
    result = spark.createDataFrame([], f"item long, id long, score long, rank long")
    batches = math.ceil(total / batch_terms)
    for number in range(batches):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(batches)) == number).filter(F.size("terms") > 0)
        held = mine.select("item", "terms").toArrow()
        if not held.num_rows:
            continue
        lists = [np.sort(np.array(t.as_py(), np.int64).view(np.uint64)) for t in held["terms"]]
        batch = _batch(held["item"].to_numpy(), lists, part)
        found = _searched(spark, docs, batch, id_col, text, k, cell_docs, seeds, dense)
        if found is not None:
            numbers = spark.createDataFrame(list(enumerate(batch.rows.tolist())), "place int, item long")
            found = found.withColumnRenamed("item", "place").join(F.broadcast(numbers), "place")
            result = result.unionByName(stored(found.select("item", "id", "score", "rank")))
    out = result.join(asked.select("item", F.col("item_id").cast(kind)), "item")
    return out.select(F.col("item_id").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


_TERMS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
ORACLE_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_TERMS} AS ws FROM documents),
stats AS MATERIALIZED (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS total FROM d WHERE len(ws) > 0),
tf AS MATERIALIZED (
  SELECT doc_id, term, count(*)::BIGINT AS tf, any_value(n)::BIGINT AS n
  FROM (SELECT doc_id, unnest(ws) AS term, len(ws) AS n FROM d) GROUP BY 1, 2),
w AS MATERIALIZED (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, stats GROUP BY term, n_docs),
asked AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term), stats GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS "rank" FROM scores WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= {K}
"""
