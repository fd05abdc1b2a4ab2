"""Helpers shared by the operators of this package: stored tables, words, hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Words of the licence and benchmark contracts: every byte outside a-z, 0-9 and non-ASCII
# separates, A-Z are lower-cased first.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
# Words between white space: A-Z lower-cased, all else as it is.
SPACED_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c == 0x20 or 0x09 <= c <= 0x0D else c for c in range(256)
)
# Odd numbers that make word hashes: a base, its inverse modulo 2 ** 64, and one to spread bits.
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see, deleted when the driver's JVM ends.

    It lies in the folder the session names in ``spark.checkpoint.dir``. Only a session on a
    single machine that names none gets one below the system's temp folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}"
    folder = f"{base.rstrip('/')}/rankwell-{uuid.uuid4().hex}"
    jvm, context = spark._jvm, spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(context.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a shared folder and read again: computed once, no lineage left."""
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Lowers the session's Arrow batches to so many rows and bytes, as rows here are whole texts."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        held = spark.conf.get(key, None)
        if held is None or not held.isdigit() or not 0 < int(held) <= most:
            spark.conf.set(key, most)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_struct(df: DataFrame, column, keep: list[str] | None = None) -> DataFrame:
    """``df`` with the fields of a struct column appended.

    An input column with the name of a field is replaced. ``keep`` limits the input columns.
    """
    name = fresh(df, "__result")
    held = df.withColumn(name, column)
    fields = held.schema[name].dataType.names
    lower = {f.lower() for f in fields}
    kept = [c for c in (keep if keep is not None else df.columns) if c.lower() not in lower]
    quoted = [held[f"`{c}`"] for c in kept]
    return held.select(*quoted, *[held[f"`{name}`.`{f}`"] for f in fields])


def as_bytes(texts: pa.Array) -> pa.Array:
    """A string array as binary, nulls as empty texts; no copy of the text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        return pc.fill_null(texts.cast(pa.large_binary()), b"")
    return pc.fill_null(texts.cast(pa.binary()), b"")


def slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) cuts of a binary array, each of ``most_bytes`` or of a single text."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, done + most_bytes, "right")))
        yield at, texts.slice(at, to - at)
        at, done = to, int(sizes[to - 1])


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array in one array, and the offset of each text in it."""
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def hashed_words(texts: list[bytes], table: bytes = WORD_TABLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Hash, text number, start and end of every word, and the lower-cased bytes they lie in.

    ``table`` lower-cases bytes and turns those that separate words, a line feed among them, into
    blanks. Hashes are well spread, but not proof against chosen words.
    """
    joined = b"\n".join(texts).translate(table)
    data = np.frombuffer(joined, np.uint8)
    inside = np.concatenate([[False], data != 0x20, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    # Prefix sums of byte * base ** place, so that a word's hash does not depend on its place.
    with np.errstate(over="ignore"):
        powers = np.full(len(data) + 1, _BASE)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        back = np.full(len(data) + 1, _BACK)
        back[0] = 1
        hashes = (sums[ends] - sums[starts]) * np.cumprod(back)[starts]
        hashes = (hashes ^ (hashes >> np.uint64(32))) * _SPREAD
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(firsts, starts, "right") - 1, starts, ends, joined
