"""Helpers that several operators of this subpackage share: stage tables, row text keys, word splitting."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import staged as stage  # noqa: F401  (the operators take it from here)
from ..sources.tables import table, unstaged

#: The bytes that part words, as every contract of this package states them.
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of an Arrow batch between Spark and Python, of which both hold several: Spark's default of 64 MB is much for tasks
#: that make several objects of each byte.
BATCH_BYTES = "8m"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir. The session's Arrow batches are bounded by BATCH_BYTES from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return table(spark, sf_dir, name)


def unstage(*frames: DataFrame | None) -> None:
    """Delete stage tables that nothing reads any more; None is none."""
    unstaged(*[df for df in frames if df is not None])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def as_rows(columns: dict[str, Iterable], schema) -> "pyarrow.RecordBatch":
    """A record batch of the columns, in the order and types of an Arrow schema."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


#: Bytes of texts that a task takes into Python objects at once, unless one text alone is larger.
SLICE_BYTES = 2_000_000


def in_slices(batches: Iterable, column: str, most: int = SLICE_BYTES) -> Iterator:
    """The record batches cut into slices of at most `most` bytes of a string or binary column, or one row. What a batch
    took is given back to the system before the next one, since a worker that waits for its next task keeps the rest."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for t in batches:
        if t.num_rows:
            total = pc.fill_null(pc.binary_length(t.column(column)), 0).to_numpy(zero_copy_only=False).cumsum(dtype="int64")
            lo = 0
            while lo < t.num_rows:
                before = int(total[lo - 1]) if lo else 0
                hi = max(lo + 1, int(total.searchsorted(before + most, "right")))
                yield t.slice(lo, hi - lo)
                lo = hi
        pa.default_memory_pool().release_unused()


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows; reads no more than it needs to tell."""
    return df.limit(rows + 1).count() <= rows


#: Rows of a few numbers up to which a table of keys is broadcast: some 20 MB. Beyond, the join is shuffled.
KEY_ROWS = 500_000


def keys_hint(keys: DataFrame) -> DataFrame:
    """A written table of keys, marked to be broadcast if it is proven to be small."""
    return F.broadcast(keys) if is_small(keys, KEY_ROWS) else keys
