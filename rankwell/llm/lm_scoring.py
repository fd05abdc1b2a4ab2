"""LM scoring: prediction by partial matching over a trie of byte contexts.

The trie is a table: one row per byte n-gram with its count in the learning texts. Escape
probabilities (method C: distinct followers over followers plus distinct followers) and symbol
exclusion depend only on a context and the context one byte longer, because whatever followed
the longer one followed the shorter one too. So the log probability of each n-gram that occurs
anywhere is worked out once, by joins and sums over the trie's levels.

Scoring deals the texts into batches. A batch asks for its distinct n-grams and words, each
once; the answers come back by a shuffle and are looked up position by position. Neither the
trie nor the vocabulary is ever held whole. Words are told apart by 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwell.llm.common import SPACED_TABLE, as_bytes, buffer_of, hashed_words, slices, stored, text_batches

# Bytes of context, bits of a symbol (a byte, or END before and after every text), symbols.
ORDER, SYMBOL_BITS, END = 5, 9, 256
SYMBOLS = 257
# Text bytes of a batch, about; bytes turned into n-grams at once; n-grams a task holds before it
# passes their counts on.
BATCH_BYTES, SLICE_BYTES, FOLD = 24 << 20, 1_000_000, 2_000_000
ROWS_OUT = 100_000
# Keys are the codes of n-grams, and -1 - code for words; the end of a text counts as this word.
END_WORD = 0
_HOME = np.uint64(0x9E3779B97F4A7C15)


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams that end at each byte and at each text's end, and where texts start.

    A code holds ORDER + 1 symbols of SYMBOL_BITS, the last one lowest; END stands before the
    first byte as often as needed.
    """
    data, offsets = buffer_of(texts)
    n = len(offsets) - 1
    # ORDER times END before each text and one after it, so that no n-gram looks into another text.
    padded = offsets + np.arange(n + 1) * (ORDER + 1)
    symbols = np.full(len(data) + n * (ORDER + 1), END, np.int64)
    inside = np.ones(len(symbols), bool)
    wanted = np.ones(len(symbols), bool)
    for back in range(ORDER):
        inside[padded[:-1] + back] = wanted[padded[:-1] + back] = False
    inside[padded[1:] - 1] = False
    symbols[inside] = data
    codes, held = symbols, 1
    while held <= ORDER:
        step = min(held, ORDER + 1 - held)
        longer = codes.copy()
        if held == step:
            longer[step:] |= codes[:-step] << (SYMBOL_BITS * step)
        else:
            # Only the lowest symbols of the n-gram that ends ``held`` places before are still missing.
            longer[held:] |= (codes[:-held] & ((1 << SYMBOL_BITS * step) - 1)) << (SYMBOL_BITS * held)
        codes, held = longer, held + step
    return codes[wanted], offsets + np.arange(n + 1)


class Codes:
    """Distinct codes from 0 on, numbered as they come, found by hashing."""

    def __init__(self, codes: np.ndarray | None = None):
        self._room(16)
        self.n, self.codes = 0, np.full(1 << 15, -1, np.int64)
        if codes is not None:
            self._append(codes)

    def _room(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)

    def _home(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * _HOME) >> self.shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The number of each code, -1 for those not held."""
        codes = np.ascontiguousarray(codes)
        at = self._home(codes)
        found = self.slots[at]
        # The last place of ``codes`` is never used, so -1 compares with no code.
        left = np.flatnonzero((self.codes[found] != codes) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            found[left] = self.slots[at[left]]
            left = left[(self.codes[found[left]] != codes[left]) & (found[left] >= 0)]
        return found

    def add(self, codes: np.ndarray) -> np.ndarray:
        """The number of each code, new ones taken in."""
        found = self.find(codes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            self._append(np.unique(codes[missing]))
            found[missing] = self.find(codes[missing])
        return found

    def _append(self, new: np.ndarray) -> None:
        """Takes in distinct codes that are not held."""
        n = self.n + len(new)
        if n >= len(self.codes):
            larger = np.full(2 * n, -1, np.int64)
            larger[: self.n] = self.codes[: self.n]
            self.codes = larger
        self.codes[self.n : n] = new
        first, self.n = self.n, n
        if 2 * n > self.mask:
            self._room(int(4 * n).bit_length())
            first = 0
        places = np.arange(first, n, dtype=np.int32)
        at = self._home(self.codes[first:n])
        while len(places):  # of those that want a slot the last one gets it, others go on to the next
            free = self.slots[at] < 0
            self.slots[at[free]] = places[free]
            left = self.slots[at] != places
            places, at = places[left], (at[left] + 1) & self.mask

    def held(self) -> np.ndarray:
        return self.codes[: self.n]


class _Counts:
    """Codes with how often they came in learning texts."""

    def __init__(self):
        self.codes, self.counts = Codes(), np.zeros(1 << 15, np.int64)

    def add(self, codes: np.ndarray, learns: np.ndarray) -> None:
        at = self.codes.add(codes)
        if self.codes.n > len(self.counts):
            self.counts = np.append(self.counts, np.zeros(self.codes.n, np.int64))
        np.add.at(self.counts, at[learns], 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        return self.codes.held(), self.counts[: self.codes.n]


def _learned_grams(texts: pa.Array, learns: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at, part in slices(texts, SLICE_BYTES):
        codes, starts = grams_of(part)
        yield codes, np.repeat(learns[at : at + len(part)], np.diff(starts))


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes from 0 on of all words of the texts, and the text of each."""
    hashes, owner, *_ = hashed_words(texts.to_pylist(), SPACED_TABLE)
    return (hashes >> np.uint64(1)).astype(np.int64), owner


def _out(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), ROWS_OUT):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + ROWS_OUT]) for c in columns], names)


def gram_counts(docs: DataFrame, text: str, learns: Column) -> DataFrame:
    """(gram, n): every distinct n-gram of all texts with its count in those that ``learns`` names.

    A task passes on what it has counted each time it holds FOLD n-grams; the sums add the parts up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _Counts()
        for batch in batches:
            learns = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for codes, learn in _learned_grams(as_bytes(batch.column(0)), learns):
                grams.add(codes, learn)
                if grams.codes.n > FOLD:
                    yield from _out(["gram", "n"], *grams.rows())
                    grams = _Counts()
        yield from _out(["gram", "n"], *grams.rows())

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    return rows.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def log_probs(grams: DataFrame) -> DataFrame:
    """(gram, logp): log10 probability of the last symbol of each n-gram after the others.

    ``grams`` (gram, n) must hold every n-gram once. From the longest context down, a symbol
    seen after the context has n / (N + D), where N and D count the context's followers and its
    distinct ones, without those that the longer context had; an unseen one costs D / (N + D)
    and goes on. Contexts never seen cost nothing. Below the empty context the symbols left are
    alike likely.

    The levels are worked out from the shortest n-grams up, each as a table: what an n-gram
    still costs once its context has failed (``rest``) is known from the n-gram one byte shorter.
    A context has at most SYMBOLS followers, so that is the most a window holds.
    """
    levels = [grams.select("gram", "n")]
    for order in range(ORDER - 1, -1, -1):
        mask = (1 << SYMBOL_BITS * (order + 1)) - 1
        levels.append(stored(levels[-1].groupBy(F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.sum("n").alias("n"))))
    levels.reverse()  # now by order
    context = Window.partitionBy(F.shiftright("gram", SYMBOL_BITS))
    followers, distinct = F.sum("n").over(context).alias("N_"), F.sum((F.col("n") > 0).cast("long")).over(context).alias("D_")
    below = levels[0].select("gram", "n", followers, distinct).withColumn("rest", -F.log10(SYMBOLS - F.col("D_")))
    for order in range(1, ORDER + 1):
        mask = (1 << SYMBOL_BITS * order) - 1
        shorter = below.select(*[F.col(c).alias(f"short_{c}") for c in ("gram", "n", "N_", "D_", "rest")])
        joined = levels[order].join(shorter, F.col("gram").bitwiseAND(mask) == F.col("short_gram"))
        excluded = F.sum(F.when(F.col("n") > 0, F.col("short_n")).otherwise(0)).over(context).alias("E_")
        placed = joined.select("gram", "n", "short_n", "short_N_", "short_D_", "short_rest", followers, distinct, excluded)
        left = F.col("short_D_") - F.col("D_")
        total = F.log10(F.col("short_N_") - F.col("E_") + left)
        rest = (
            F.when(F.col("short_n") > 0, F.log10("short_n") - total)
            .when(left > 0, F.log10(left) - total + F.col("short_rest"))
            .otherwise(F.col("short_rest"))
        )
        below = placed.select("gram", "n", "N_", "D_", rest.alias("rest"))
        if order < ORDER:
            below = stored(below)
    total = F.log10(F.col("N_") + F.col("D_"))
    value = F.when(F.col("n") > 0, F.log10("n") - total).when(F.col("D_") > 0, F.log10("D_") - total + F.col("rest"))
    return below.select("gram", value.otherwise(F.col("rest")).alias("logp"))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch, key, value): each batch's distinct n-grams, and words with their learning count."""
    words: dict[int, _Counts] = {}
    grams: dict[int, Codes] = {}
    for rows in batches:
        texts, learns = as_bytes(rows.column("text")), rows.column("learns").to_numpy(zero_copy_only=False).astype(bool)
        numbers = rows.column("batch").to_numpy()
        for number in np.unique(numbers).tolist():
            at = np.flatnonzero(numbers == number)
            own, held = grams.setdefault(number, Codes()), words.setdefault(number, _Counts())
            mine, learn = texts.take(pa.array(at)), learns[at]
            for first, part in slices(mine, SLICE_BYTES):
                own.add(grams_of(part)[0])
                found, owner = words_of(part)
                held.add(found, learn[first : first + len(part)][owner])
                # The end of each text is a word too.
                held.add(np.full(len(part), END_WORD), learn[first : first + len(part)])
    for number, held in words.items():
        codes, counts = held.rows()
        keys = np.concatenate([-1 - codes, grams[number].held()])
        values = np.concatenate([counts.astype(np.float64), np.zeros(grams[number].n)])
        yield from _out(["batch", "key", "value"], np.full(len(keys), number, np.int32), keys, values)


SCORES = "held_out boolean, n_tokens long, n_known long, logs double, score double, batch_tokens double, batch_words long"


def _scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Scores of one batch's texts from the answers to what it asked for."""
    keys, values = answers.column("key").to_numpy(), answers.column("value").to_numpy()
    named, coded = np.flatnonzero(keys < 0), np.flatnonzero(keys >= 0)
    counts, first = values[named], answers.column("first").to_numpy(zero_copy_only=False).astype(bool)[named]
    words, logs = Codes(-1 - keys[named]), np.log10(counts + 0.5)
    grams, logp = Codes(keys[coded]), values[coded]
    end = words.find(np.array([END_WORD]))[0] if len(named) else -1
    tokens, known, sums, scores = [], [], [], []
    for chunk in rows.column("text").chunks:
        for _, part in slices(as_bytes(chunk), SLICE_BYTES):
            found, owner = words_of(part)
            at = words.find(found)
            tokens.append(np.bincount(owner, minlength=len(part)) + 1)
            known.append(np.bincount(owner, counts[at] > 0, len(part)).astype(np.int64) + int(counts[end] > 0))
            sums.append(np.bincount(owner, logs[at], len(part)) + logs[end])
            codes, starts = grams_of(part)
            scores.append(np.add.reduceat(logp[grams.find(codes)], starts[:-1]))
    n = rows.num_rows
    return pa.table(
        {
            "id": rows.column("id"),
            "held_out": pa.array(~rows.column("learns").to_numpy(zero_copy_only=False).astype(bool)),
            "n_tokens": pa.array(np.concatenate(tokens)),
            "n_known": pa.array(np.concatenate(known)),
            "logs": pa.array(np.concatenate(sums)),
            "score": pa.array(np.concatenate(scores)),
            "batch_tokens": pa.array(np.full(n, counts[first].sum())),
            "batch_words": pa.array(np.full(n, int((counts[first] > 0).sum()), np.int64)),
            "batch": rows.column("batch"),
        }
    )


def score(docs: DataFrame, learns: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``learns`` tells the rows whose texts teach both models; null counts as false. Null texts
    are empty. ``score`` is the log10 probability of the bytes and the end of the text under
    the n-gram trie; with nothing learned every symbol is alike likely.
    ``base_score`` is that of the words (ASCII white space separates, A-Z lower-cased) and one
    end per text under smoothed word counts. Repeated ids keep a row each; other columns go.
    """
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns")
    )
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    batches = 1 + size // BATCH_BYTES
    probs = stored(log_probs(stored(gram_counts(rows, "text", F.col("learns")))))

    parts = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Equal rows have one hash, so the part they are read from deals them out over the batches.
    number = F.pmod(F.xxhash64("id", "text") + F.spark_partition_id(), F.lit(batches)).cast("int")
    dealt = rows.withColumn("batch", number).repartition(parts, "batch")
    # All columns, though the ids are not looked at: so both uses of the texts share one shuffle.
    asked = dealt.mapInArrow(_asked, "batch int, key long, value double")
    told = probs.select(F.lit(None).cast("int").alias("batch"), F.col("gram").alias("key"), F.col("logp").alias("value"))
    same = Window.partitionBy("key")
    answers = (
        asked.unionByName(told)
        .select("batch", "key", F.sum("value").over(same).alias("value"), F.min("batch").over(same).alias("least"))
        .filter("batch is not null")
        .select("batch", "key", "value", (F.col("batch") == F.col("least")).alias("first"))
    )
    kind = docs.schema[id_col].dataType.simpleString()
    found = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_scored, f"id {kind}, {SCORES}, batch int")
    found = stored(found)
    totals = found.groupBy("batch").agg(F.first("batch_tokens").alias("t"), F.first("batch_words").alias("w"))
    n, v = totals.agg(F.coalesce(F.sum("t"), F.lit(0.0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(n + 0.5 * (v + 1)))
    return found.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )


def learned(docs: DataFrame, id_col: str = "doc_id", folds: int = 5, held: int = 1) -> Column:
    """Whether crc32 of the id as text leaves another remainder than ``held``; true for null ids."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != held, F.lit(True))
