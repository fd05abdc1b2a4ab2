"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import as_bytes, slices, text_batches, with_struct

# n-grams of 1 to 3 characters share 2 ** BUCKET_BITS buckets; SMOOTHING is added to each count.
ORDERS, BUCKET_BITS, SMOOTHING = 3, 15, 0.5
UNKNOWN = "und"
# A table of more languages than this is refused: the matrix is sent to every worker.
MAX_LANGUAGES = 1000
# A text fits no language if its n-grams are on average UNLIKELY nats less likely than the
# language's own, and contradicts its label if another language makes them CONTRADICTED nats more
# likely, and more by what the label's counts leave open: with DOUBT times the smoothing's mass in
# unseen n-grams of the label, all of them could be more likely by that much.
UNLIKELY, CONTRADICTED, DOUBT = 2.5, 1.25, 2.0
SLICE_BYTES = 1_000_000
# Numbers that mix the characters of an n-gram, odd and of 64 bits.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _points(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased codepoints of all texts, white space runs as they are, and where each text starts."""
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
    return np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), starts


def _grams(points: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bucket of the n-gram that ends at each character, for n from 1 to ORDERS.

    An n-gram that begins before the text belongs to the text before; the few of them weigh
    nothing, but are masked by the callers.
    """
    mixed = np.zeros(len(points), np.uint64)
    for n in range(1, ORDERS + 1):
        mixed[n - 1 :] += points[: len(points) - n + 1] * _MIX[n - 1]
        yield ((mixed * _MIX[0]) >> np.uint64(64 - bits)).astype(np.int32)


def counted(rows: DataFrame, text: str, lang: str, bits: int = BUCKET_BITS) -> DataFrame:
    """(lang, bucket, n) over all rows with a language; each task adds its batches up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1)
            for at, part in slices(as_bytes(batch.column(0)), SLICE_BYTES):
                points, starts = _points(part.to_pylist())
                names = langs.slice(at, len(part)).to_pylist()
                order = {name: i for i, name in enumerate(dict.fromkeys(names))}
                owner = np.repeat([order[name] for name in names], np.diff(starts))
                sums = np.zeros(len(order) << bits, np.int64)
                for n, grams in enumerate(_grams(points, bits), 1):
                    whole = np.arange(len(points)) - np.repeat(starts[:-1], np.diff(starts)) >= n - 1
                    sums += np.bincount((owner[whole] << bits) + grams[whole], minlength=len(sums))
                for name, i in order.items():
                    mine = sums[i << bits : (i + 1) << bits]
                    if name in totals:
                        totals[name] += mine
                    else:
                        totals[name] = mine.copy()
        for name, sums in totals.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(sums[at])], ["lang", "bucket", "n"]
            )

    text_batches(rows.sparkSession)
    pairs = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    counts = pairs.mapInArrow(count, "lang string, bucket int, n long")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages and the log probability of each bucket (buckets x languages).

    ``expected`` is the mean log probability of a language's own n-grams, ``doubt`` how far it may be
    off for want of them; it narrows as their number grows.
    """

    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = SMOOTHING):
        self.languages = languages
        self.bits = counts.shape[0].bit_length() - 1
        smooth = counts + smoothing
        self.logs = np.log(smooth / smooth.sum(axis=0)).astype(np.float32) if languages else np.zeros((counts.shape[0], 0), np.float32)
        self.expected = (np.exp(self.logs, dtype=np.float64) * self.logs).sum(axis=0)
        self.doubt = np.log1p(DOUBT * smoothing * len(counts) / np.maximum(counts.sum(axis=0), 1))

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """Log likelihood of each text (rows) in each language, and its n-grams' number last."""
        points, starts = _points(texts)
        sizes = np.diff(starts)
        out = np.zeros((len(texts), len(self.languages) + 1))
        some = np.flatnonzero(sizes)
        if not len(some):
            return out
        place = np.arange(len(points)) - np.repeat(starts[:-1], sizes)
        for n, grams in enumerate(_grams(points, self.bits), 1):
            logs = self.logs[grams]
            if n > 1:
                logs[place < n - 1] = 0
            out[some, :-1] += np.add.reduceat(logs, starts[some], axis=0, dtype=np.float64)
        out[:, -1] = sum(np.maximum(sizes - n, 0) for n in range(ORDERS))
        return out


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", bits: int = BUCKET_BITS) -> Model:
    """Counts of all rows with text and language; the driver gets at most languages x 2 ** bits.

    Raises ValueError for more than ``MAX_LANGUAGES`` languages. No rows give no languages.
    """
    counts = counted(rows, text, lang, bits).groupBy("lang").agg(
        F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts")
    )
    found = sorted(counts.limit(MAX_LANGUAGES + 1).collect(), key=lambda r: r.lang)
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((1 << bits, len(found)))
    for i, r in enumerate(found):
        table[r.buckets, i] = r.counts
    return Model([r.lang for r in found], table)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred (und for null texts or texts without a letter) and score.

    The score is the posterior of the predicted language, all languages being alike likely
    beforehand and the evidence of a text counted as that of at most ``EVIDENCE`` n-grams, so
    that long texts do not all have 1; und has 0. Ties go to the first language by name.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        names = model.languages
        step = max(1000, 4 * SLICE_BYTES // max(4, len(names)))
        for texts in batches:
            langs: list[str] = []
            scores: list[float] = []
            for _, part in slices(as_bytes(texts), step):
                raw = part.to_pylist()
                totals = totals_of(model, raw, step)
                for i, t in enumerate(raw):
                    if not names or not any(map(str.isalpha, t.decode("utf-8", "replace"))):
                        langs.append(UNKNOWN), scores.append(0.0)
                        continue
                    row, n = totals[i, :-1], totals[i, -1]
                    best = int(row.argmax())
                    odds = np.exp((row - row[best]) * min(1.0, EVIDENCE / n))
                    langs.append(names[best]), scores.append(float(1 / odds.sum()))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return with_struct(docs, predict(docs[f"`{text}`"]))


def fitting(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows of ``docs`` with a letter, whose text fits some language and does not contradict ``lang``.

    Texts go whose n-grams are on average more than ``UNLIKELY`` nats below what the best language
    expects of its own, and texts that another language makes more than ``CONTRADICTED`` nats an
    n-gram likelier than their label does, after what few n-grams of the label leave in doubt. A null
    label, or one the model has not learned, contradicts nothing. A model without languages leaves all texts with a letter.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def fits(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = shared.value
        number = {name: i for i, name in enumerate(model.languages)}
        step = max(1000, 4 * SLICE_BYTES // max(4, len(number)))
        for texts, labels in batches:
            out: list[bool] = []
            for at, part in slices(as_bytes(texts), step):
                raw = part.to_pylist()
                totals = totals_of(model, raw, step)
                for i, (t, label) in enumerate(zip(raw, labels.slice(at, len(raw)).to_pylist())):
                    lettered = any(map(str.isalpha, t.decode("utf-8", "replace")))
                    if not number or not lettered:
                        out.append(lettered)
                        continue
                    row = totals[i, :-1] / totals[i, -1]
                    best, own = int(row.argmax()), number.get(label)
                    likely = row[best] >= model.expected[best] - UNLIKELY
                    contradicted = own is not None and row[best] - row[own] > CONTRADICTED + model.doubt[own]
                    out.append(bool(likely and not contradicted))
            yield pa.array(out, pa.bool_())

    return docs.filter(fits(docs[f"`{text}`"], docs[f"`{lang}`"]))


EVIDENCE = 100


def totals_of(model: Model, texts: list[bytes], most: int) -> np.ndarray:
    """Totals of texts; a text longer than ``most`` is added up from pieces that overlap."""
    if len(texts) > 1 or not texts or len(texts[0]) <= most:
        return model.totals(texts)
    text = texts[0].decode("utf-8", "replace").lower()
    out = np.zeros((1, len(model.languages) + 1))
    for at in range(0, len(text), most):
        lead = text[max(0, at - ORDERS + 1) : at]
        out += model.totals([(lead + text[at : at + most]).encode("utf-8", "surrogatepass")])
        if lead:
            out -= model.totals([lead.encode("utf-8", "surrogatepass")])
    return out


def learned(docs: DataFrame, id_col: str = "doc_id", folds: int = 4, held: int = 2) -> Column:
    """Whether a row is held out: crc32 of its id as text modulo ``folds``; null ids are not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held, F.lit(False))
