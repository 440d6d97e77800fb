"""Readers and writers: schemas are explicit, columns are pruned at the scan, stages are Parquet."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardloom.session import stage_path


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read a CSV file with a header, or Parquet for any other path.

    ``columns`` prunes the scan. CSV needs ``schema``: inferring one would read the data twice.
    """
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        table = spark.read.csv(path, schema=schema, header=True)
    else:
        table = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    return table.select(*columns) if columns else table


def spread(df: DataFrame) -> DataFrame:
    """Deal out a stored table that has fewer pieces than the session has cores.

    A single small file would otherwise keep one core busy through every join after it. A large table has many
    pieces and passes unchanged. Meant for a plain scan, whose piece count is known without running anything.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by key before they are stored, so that later aggregations combine a key's rows before they shuffle.

    Joins leave the rows of a key all over the pieces, more of them the larger the table: partial aggregates then number as many
    as the rows. Spark cuts crowded pieces, so a long key still spreads over the tasks.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys])


def parse_dates(df: DataFrame, columns: Sequence[str], pattern: str | None = None) -> DataFrame:
    """Turn text columns into zone-free timestamps."""
    arguments = (F.lit(pattern),) if pattern else ()
    return df.withColumns({c: F.to_timestamp_ntz(F.col(c), *arguments) for c in columns})


def head(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of a stated order; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)


def read_names(spark: SparkSession, path: str, name: str = "feature") -> DataFrame:
    """Read a headerless one-column file and name its column."""
    return spark.read.csv(path, schema=f"{name} string", header=False)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table without any index column; CSV gets a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_names(df: DataFrame, path: str) -> None:
    """Write a one-column list without a header."""
    df.write.mode("overwrite").option("header", False).csv(path)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is removed at its end, not when the driver next collects garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before or "false")


def stage(df: DataFrame, name: str, path: str | None = None, freed: bool = False) -> DataFrame:
    """Write one pipeline stage as Parquet and read it back, which ends the lineage there.

    ``freed`` spares the disk, for stages of whole rows whose lineage nothing runs again: what they shuffled is removed as soon as
    they are written, and they are compressed harder.
    """
    path = path or stage_path(df.sparkSession, name)
    if freed:
        with freed_shuffles(df.sparkSession):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    else:
        write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    """Write one stage in buckets by key: groupings, windows and joins by these keys then shuffle nothing.

    A bucket is read by one task, so no key may have more rows than a task should hold. The table is external: its files lie
    with the other stages.
    """
    path = stage_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    with freed_shuffles(df.sparkSession):
        dealt.write.format("parquet").bucketBy(buckets, *keys).option("path", path).option("compression", "zstd").saveAsTable(table)
    return df.sparkSession.table(table)


def write_predictions(df: DataFrame, path: str, key: str = "card_id", prediction: str = "prediction",
                      name: str = "target", fmt: str = "csv") -> None:
    """Write the submission table: one key and one predicted value per row."""
    write_table(df.select(key, F.col(prediction).alias(name)), path, fmt)


def write_scores(df: DataFrame, path: str, key: str, label: str, probability: str) -> None:
    """Store label and probability vectors, keyed, for a later stacking or threshold run."""
    write_table(df.select(key, F.col(label).alias("y"), F.col(probability).alias("prob")), path)
