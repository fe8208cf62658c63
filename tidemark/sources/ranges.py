"""A sink of ranges of rows that a long job can stop and take up again.

Rows are numbered from 1, and each range of `size` numbers is a folder of its own, `rows=<first> to <last>`. Beside the
folder that holds them stands a ledger, to which every step appends: that ranges are begun, before their folders are touched,
and that they are finished, with what was read back from them. A range counts as finished if its last entry says so; a job
that died while it wrote leaves entries without an end, whose ranges the next run writes again. A folder is replaced as a
whole by the commit of the job that writes it, so a range that is written twice replaces itself and no other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .tables import _delete, _exists, by_rows

#: Jobs of a run at most, where ranges are so many that a job takes more than AT_ONCE.
AT_ONCE, JOBS = 64, 16
#: Tasks that write or list the ranges of a job.
PARTS = 64
_ENTRY = "first long, last long, step long, state string, n_rows long, fingerprint long"


def bounds(row: Column, size: int) -> tuple[Column, Column]:
    """First and last number of the range that a row number is in."""
    first = F.floor((row - 1) / size).cast("long") * size + 1
    return first, first + size - 1


def _label(first: Column, last: Column) -> Column:
    return F.concat(first.cast("string"), F.lit(" to "), last.cast("string"))


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}-ledger"


def _entries(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_ENTRY).parquet(_beside(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], _ENTRY)


def _listed(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    """The rows of these folders of path, and of no other: listing all of them for each job would grow with their square.
    Folders are listed by a few tasks, not by one each, as every task's outcome goes to the driver."""
    if not folders:
        return spark.createDataFrame([], schema)
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, PARTS)
    try:
        return spark.read.schema(schema).option("basePath", path).csv(folders, header=True, nullValue="NA")
    finally:
        spark.conf.set(name, before)


def range_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(first, last, state, n_rows, fingerprint) of every range that was ever begun: its last entry. n_rows and the
    fingerprint, in which order plays no part, are those of the folder as it was read back; null while `begun`."""
    last = _entries(spark, path).groupBy("first", "last").agg(F.max_by(F.struct("state", "n_rows", "fingerprint"), "step").alias("e"))
    return last.select("first", "last", "e.*")


def read_ranges(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all finished ranges and their range, `rows`; folders that a dead job left half-way are passed over."""
    done = range_ledger(spark, path).filter("state = 'finished'").select(_label(F.col("first"), F.col("last")).alias("rows"))
    return spark.read.schema(f"{schema}, rows string").csv(path, header=True, nullValue="NA").join(by_rows(done), "rows", "left_semi")


def write_ranges(df: DataFrame, path: str, row: str, size: int, at_once: int | None = None, only: Sequence[int] | None = None, again: bool = False) -> int:
    """Write the ranges of df that the ledger doesn't have as finished, `at_once` of them a job (by default AT_ONCE, or so
    many more that JOBS jobs do: each reads df); how many were written.

    df has a column `row` of numbers from 1, which is written with the others; rows whose number is null or below 1 raise
    an error, as no range would hold them, and so does a path with ranges of another size, which would overlap. `only` names ranges by any row number in them; with `again`, finished ones are
    written once more. The ledger is read by range, never by row, and df is filtered by row number for each job, which a
    source that is ordered by it answers from its statistics.
    """
    spark = df.sparkSession
    low, high, odd = df.agg(F.min(row), F.max(row), F.count_if(F.col(row).isNull() | (F.col(row) < 1))).first()
    if odd:
        raise ValueError(f"{odd} rows have no number from 1 on in {row}")
    if low is None:
        return 0
    index = lambda number: (int(number) - 1) // size
    ledger = range_ledger(spark, path)
    if not ledger.filter(f"last <> first + {size} - 1").isEmpty():
        raise ValueError(f"{path} has ranges of another size")
    finished = ledger.filter("state = 'finished'")
    done = set() if again else {index(r.first) for r in finished.select("first").toLocalIterator()}  # numbers of ranges, not of rows
    wanted = range(index(low), index(high) + 1) if only is None else sorted({index(i) for i in only})
    left = [i for i in wanted if i not in done]
    columns = [c for c in df.columns if c != "rows"]
    schema = StructType([*df.select(*columns).schema.fields, StructField("rows", StringType())])
    step = (_entries(spark, path).agg(F.max("step")).first()[0] or 0) + 1
    at_once = at_once or max(AT_ONCE, -(-len(left) // JOBS))

    def note(entries: DataFrame) -> None:
        entries.select(*[F.col(c.split()[0]) for c in _ENTRY.split(", ")]).coalesce(1).write.mode("append").parquet(_beside(path))

    for at in range(0, len(left), at_once):
        group = left[at : at + at_once]
        of = [(i * size + 1, (i + 1) * size) for i in group]
        within = F.col(row).between(of[0][0], of[-1][1])
        first, last = bounds(F.col(row), size)
        begun = spark.createDataFrame(of, "first long, last long")
        whole = group[-1] - group[0] + 1 == len(group)
        chosen = df.filter(within if whole else within & first.isin([a for a, _ in of])).select(*columns, _label(first, last).alias("rows"))
        chosen = chosen.repartition(min(len(group), PARTS), "rows")  # one file a range, whatever the source's order
        note(begun.select("first", "last", F.lit(step).alias("step"), F.lit("begun").alias("state"), F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("long").alias("fingerprint")))
        folders = [f"{path.rstrip('/')}/rows={a} to {b}" for a, b in of]
        for folder in folders:  # a range that has no rows any more must not keep its old ones
            _delete(spark, folder)
        chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("rows").csv(path, header=True, nullValue="NA")
        names = begun.withColumn("rows", _label(F.col("first"), F.col("last")))
        read = _listed(spark, path, [f for f in folders if _exists(spark, f)], schema)
        found = read.groupBy("rows").agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(F.xxhash64(*columns)).alias("fingerprint"))
        note(names.join(by_rows(found), "rows", "left").select("first", "last", F.lit(step + 1).alias("step"), F.lit("finished").alias("state"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "fingerprint"))
        step += 2
    return len(left)


def expected_ranges(spark: SparkSession, n_rows: int, size: int) -> DataFrame:
    """(first, last, n_expected) of all ranges that rows 1 to n_rows fill; the last one may have fewer than size."""
    starts = spark.range(1, n_rows + 1, size).select(F.col("id").alias("first"))
    return starts.select("first", (F.col("first") + size - 1).alias("last"), F.least(F.lit(size), F.lit(n_rows + 1) - F.col("first")).cast("long").alias("n_expected"))


def range_report(expected: DataFrame, ledger: DataFrame) -> DataFrame:
    """(first, last, n_expected, n_rows, verdict) of every range of either: complete, short (fewer rows than expected),
    long, unfinished (begun only), missing (expected, never begun) or unexpected."""
    found = ledger.select("first", "last", "state", "n_rows")
    both = expected.join(found, ["first", "last"], "full")
    n, m = F.col("n_rows"), F.col("n_expected")
    verdict = F.when(m.isNull(), "unexpected").when(F.col("state").isNull(), "missing").when(F.col("state") == "begun", "unfinished").when(n < m, "short").when(n > m, "long").otherwise("complete")
    return both.select("first", "last", "n_expected", "n_rows", verdict.alias("verdict"))
