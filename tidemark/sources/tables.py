"""Reading and writing tables, and row combination by key."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, with_file: bool = False, numbered: bool = False) -> DataFrame:
    """CSV files (plain or gzip) with a header; NA is null. numbered: the files begin with an unnamed column of row
    numbers, which is left out. with_file adds a column `file` with each row's file name."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kind = StructType([StructField("_row", StringType()), *kind.fields]) if numbered else kind
    df = spark.read.csv(list(paths) if not isinstance(paths, str) else paths, schema=kind, header=True, nullValue="NA", enforceSchema=True)
    columns = [c for c in df.columns if not (numbered and c == "_row")]
    return df.select(*columns, *([F.col("_metadata.file_name").alias("file")] if with_file else []))


def write_csv(df: DataFrame, path: str, by: Sequence[str] = (), compression: str = "none") -> None:
    """CSV with a header and nulls as NA, in a folder for each value of `by`."""
    df.write.mode("overwrite").partitionBy(*by).csv(path, header=True, nullValue="NA", compression=compression)


def with_row_numbers(df: DataFrame, order: Sequence[str], into: str = "rowname") -> DataFrame:
    """df with row numbers from 1 in the order of columns that tell all rows apart. Rows are dealt into ranges of the order,
    whose counts are summed, so the table is not sorted in one place. A column of that name is replaced."""
    kept = [c for c in df.columns if c != into]
    keys = [f"k{i}" for i in range(len(order))]
    rows = df.select(F.struct(*kept).alias("row"), *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)])
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("row", F.monotonically_increasing_id().alias("id"))
    ranged = staged(ranged.withColumn("part", F.shiftright("id", 33)), "ranged")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sizes.select("part", "least", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ranged.join(F.broadcast(starts), "part").select("row.*", (F.col("before") + F.col("id") - F.col("least") + 1).alias(into))


def year_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.isdigit() and len(c) == 4 and c.startswith("20")]


def union_filled(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column that a frame lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def replace_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with all rows of new's keys replaced by new's."""
    return union_filled(old.join(new.select(*keys).distinct(), list(keys), "left_anti"), new)


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """df with the columns of `like`, in its order and types; missing ones are null."""
    kinds = dict(like.dtypes)
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in like.columns])


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys of each frame the other lacks, and whether the sets are equal or disjoint."""
    both = a.select(*keys).distinct().withColumn("_a", F.lit(1)).join(b.select(*keys).distinct().withColumn("_b", F.lit(1)), list(keys), "full")
    out = both.agg(F.count_if(F.col("_b").isNull()).alias("only_first"), F.count_if(F.col("_a").isNull()).alias("only_second"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("in_both"))
    return out.withColumns({"equal_sets": (F.col("only_first") == 0) & (F.col("only_second") == 0), "disjoint_sets": F.col("in_both") == 0})


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key, by an explicit order."""
    columns = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.min_by(columns, F.struct(*order)).alias("_r")).select("_r.*")


_written: set[str] = set()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir; a fixed one on a local master). What is
    written there is deleted when the driver ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "/tmp/checkpoints/tidemark"
    if not _written:
        atexit.register(_delete_all, spark)
    path = f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.add(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to a path of `shared_path`, and read again. `unstaged` deletes it earlier."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def unstaged(*frames: DataFrame) -> None:
    """Delete tables of `staged` that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_tidemark_path", None)
        if path in _written:
            _written.remove(path)
            _delete(df.sparkSession, path)


def by_rows(df: DataFrame) -> DataFrame:
    """df, as many rows as the input or its groups: joins sort it. Spark would guess its size from compressed files, take a
    table of a million rows for a small one, and gather it in the driver to broadcast it."""
    return df.hint("merge")


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _delete_all(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    while _written:
        _delete(spark, _written.pop())
