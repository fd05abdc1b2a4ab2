"""Benchmark decontamination by winnowing: fingerprints joined, hits extended to whole windows.

Of every WINDOW - GRAM + 1 consecutive GRAM-word grams the one of least hash is a fingerprint.
A span of WINDOW words that a document and an item share has the same least gram in both, so
the join of fingerprints meets it; comparing the words around then tells how far it reaches.
Items shorter than a window are one gram each, and of their lengths every gram is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwell.llm.common import as_bytes, fresh, hashed_words, slices, stored, text_batches

WINDOW, GRAM = 10, 5
# The bitmap of item fingerprints that every task gets has 2 ** FILTER_BITS bits, however many
# items there are; a full one only lets more through to the join.
FILTER_BITS = 22
SLICE_BYTES = 1_000_000
_STEP, _SPREAD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)

FOUND = pa.struct(
    [
        ("size", pa.int32()),
        ("hash", pa.int64()),
        ("at", pa.int64()),
        ("left", pa.list_(pa.string())),
        ("right", pa.list_(pa.string())),
    ]
)
FIELDS = "n_words long, grams array<struct<size int, hash long, at long, left array<string>, right array<string>>>"


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = out * _STEP + words[j : j + n]
        out = (out ^ (out >> np.uint64(31))) * _SPREAD
        return out ^ (out >> np.uint64(29))


def winnowed(words: np.ndarray, owner: np.ndarray, span: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(gram size, places, hashes) of the fingerprints for spans of ``span`` words.

    The least hash of each window is taken, the last one of equals. ``owner`` keeps windows
    within their text.
    """
    size = GRAM if span == WINDOW else span
    hashes = gram_hashes(words, size)
    n = len(words) - span + 1
    if n <= 0:
        return size, np.zeros(0, np.int64), hashes[:0]
    whole = np.flatnonzero(owner[:n] == owner[span - 1 :])
    if span > size:
        windows = np.lib.stride_tricks.sliding_window_view(hashes, span - size + 1)[whole]
        places = np.unique(whole + (span - size) - windows[:, ::-1].argmin(axis=1))
    else:
        places = whole
    return size, places, hashes[places]


def _found(texts: list[bytes], spans: list[int], own: bool, bitmap: np.ndarray | None) -> pa.Array:
    words, owner, starts, ends, joined = hashed_words(texts)
    counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    rows: list[list[dict]] = [[] for _ in texts]
    reach = WINDOW - GRAM
    for span in spans:
        size, places, hashes = winnowed(words, owner, span)
        if bitmap is not None:
            bits = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            hit = (bitmap[bits >> 3] >> (bits & 7)) & 1 == 1
            places, hashes = places[hit], hashes[hit]
        if own:  # an item is cut into windows of its own length, up to WINDOW
            mine = np.minimum(counts[owner[places]], WINDOW) == span
            places, hashes = places[mine], hashes[mine]
        around = reach if span == WINDOW else 0
        for p, h in zip(places.tolist(), hashes.view(np.int64).tolist()):
            t = int(owner[p])
            left = [joined[starts[i] : ends[i]].decode() for i in range(p - 1, max(first[t], p - around) - 1, -1)]
            right = [joined[starts[i] : ends[i]].decode() for i in range(p + size, min(first[t + 1], p + size + around))]
            rows[t].append({"size": span, "hash": h, "at": p - int(first[t]), "left": left, "right": right})
    return pa.StructArray.from_arrays([pa.array(counts), pa.array(rows, pa.list_(FOUND))], ["n_words", "grams"])


def _fingerprinted(df: DataFrame, text: str, name: str, spans: list[int], own: bool, bitmap=None) -> DataFrame:
    text_batches(df.sparkSession)

    @F.arrow_udf(FIELDS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mask = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for texts in batches:
            parts = [_found(p.to_pylist(), spans, own, mask) for _, p in slices(as_bytes(texts), SLICE_BYTES)]
            yield pa.concat_arrays(parts) if parts else _found([], spans, own, mask)

    return df.withColumn(name, found(df[f"`{text}`"]))


def item_fingerprints(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """(size, hash, item_id, left, right): fingerprints of every item with the words around."""
    chosen = items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    found = _fingerprinted(chosen, "text", "found", list(range(1, WINDOW + 1)), True)
    grams = found.select("item_id", F.explode("found.grams").alias("g"))
    return grams.select("g.size", "g.hash", "item_id", "g.left", "g.right").distinct()


def filter_bitmap(prints: DataFrame) -> tuple[bytes, list[int]]:
    """The bitmap of the fingerprints' hashes, and the window lengths that occur.

    The driver gets at most 2 ** FILTER_BITS / 64 numbers, of all items together.
    """
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = prints.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("bits")
    )
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words.collect():
        out[r.word] = r.bits
    sizes = [r.size for r in prints.select("size").distinct().collect()]  # at most WINDOW values
    return out.astype("<i8").tobytes(), sorted(sizes)


def _alike(a: str, b: str, n: int) -> Column:
    """How many leading words two arrays share, of at most ``n``."""
    out = F.lit(0)
    for i in reversed(range(n)):
        out = F.when(F.get(a, F.lit(i)) == F.get(b, F.lit(i)), out + 1).otherwise(0)
    return out


def hits(grams: DataFrame, prints: DataFrame, row: str) -> DataFrame:
    """(row, item_id, start, end): shared spans around each common fingerprint, ends exclusive."""
    size = F.when(F.col("size") == WINDOW, GRAM).otherwise(F.col("size"))
    theirs = prints.withColumnsRenamed({"left": "item_left", "right": "item_right"})
    reach = WINDOW - GRAM
    met = grams.join(theirs, ["size", "hash"]).select(
        row, "item_id", "size", "at", size.alias("gram"), _alike("left", "item_left", reach).alias("l"), _alike("right", "item_right", reach).alias("r")
    )
    return met.filter(F.col("l") + F.col("gram") + F.col("r") >= F.col("size")).select(
        row, "item_id", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + F.col("gram") + F.col("r")).alias("end")
    )


def _met(docs: DataFrame, columns: list[str], items: DataFrame, text: str, item_id: str, item_text: str, row: str, found: str):
    """(columns, row number and fingerprints of every document, stored; hits of the rows that have any)."""
    prints = stored(item_fingerprints(items, item_id, item_text))
    bitmap, spans = filter_bitmap(prints)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    wanted = docs.select(*[docs[f"`{c}`"] for c in columns], F.col(f"`{text}`").alias(fresh(docs, "__text")))
    name = wanted.columns[-1]
    marked = _fingerprinted(wanted.withColumn(row, F.monotonically_increasing_id()), name, found, spans, False, shared)
    marked = stored(marked.drop(name))
    grams = marked.select(row, F.explode(F.col(f"{found}.grams")).alias("g")).select(row, "g.*")
    return marked, hits(grams, prints, row)


def scan(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str] | None = None,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with n_words, n_hit, spans (array of start, end) and item_ids (array of strings).

    A window is WINDOW consecutive words of an item, or all words of a shorter one; a word of a
    document inside any occurrence of a window is hit. ``spans`` are the hit runs, ends
    exclusive, and ``item_ids`` the ids of the items with an occurring window, distinct and
    sorted as strings. Items without id mark words but are not listed. Null and empty texts and
    items have no words. ``keep`` names the columns to keep (all if None); those named as a
    result are replaced. Rows are told apart by place, so repeated ids do no harm.
    """
    row, found = fresh(docs, "__row"), fresh(docs, "__found")
    taken = {"n_words", "n_hit", "spans", "item_ids"}
    columns = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    marked, met = _met(docs, columns, items, text, item_id, item_text, row, found)
    met = _united(met, row)
    out = marked.join(met, row, "left")
    nothing = F.array().cast("array<struct<start: bigint, end: bigint>>")
    runs = F.coalesce("__runs", nothing)
    length = F.aggregate(runs, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        *[f"`{c}`" for c in columns],
        F.col(f"{found}.n_words").alias("n_words"),
        length.alias("n_hit"),
        runs.alias("spans"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("item_ids"),
    )


def _united(met: DataFrame, row: str) -> DataFrame:
    """(row, __runs, __items): overlapping and touching spans of a row joined, ids as a sorted set.

    The windows order the spans of one document, never of several.
    """
    before = Window.partitionBy(row).orderBy("start", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(F.col("start") <= reached, 0).otherwise(1)
    spans = met.groupBy(row, "start", "end").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    numbered = spans.withColumn("opened", opened).withColumn("run", F.sum("opened").over(before))
    runs = numbered.groupBy(row, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.flatten(F.collect_list("items")).alias("items")
    )
    return runs.groupBy(row).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("__items"),
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit word, columns as they were; see ``scan``.

    Rows without a fingerprint of an item, nearly all, are passed on as they are; only the others
    are joined with what was found in them.
    """
    name, row, found = fresh(docs, "__docs"), fresh(docs, "__row"), fresh(docs, "__found")
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(name), F.col(f"`{text}`").alias("text"))
    marked, met = _met(whole, [name], items, "text", item_id, item_text, row, found)
    none = F.size(F.col(f"{found}.grams")) == 0
    kept = marked.filter(none).select(name).union(marked.filter(~none).join(met.select(row).distinct(), row, "left_anti").select(name))
    return kept.select(*[F.col(f"`{name}`.`{c}`").alias(c) for c in docs.columns])


_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
ORACLE_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS MATERIALIZED (SELECT item_id, {_WORDS} AS ws FROM benchmark),
sized AS MATERIALIZED (SELECT item_id, ws, least(len(ws), {WINDOW}) AS n FROM i WHERE len(ws) > 0),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS w
  FROM sized, unnest(range(1, len(ws) - n + 2)) AS t(s)),
places AS MATERIALIZED (
  SELECT doc_id, n, s, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS w
  FROM d CROSS JOIN (SELECT DISTINCT n FROM windows), unnest(range(1, len(ws) - n + 2)) AS t(s)),
hits AS MATERIALIZED (SELECT doc_id, item_id, n, s FROM places JOIN windows USING (n, w)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + n)) AS t(p) GROUP BY 1),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN found ON found.doc_id = d.doc_id
"""
