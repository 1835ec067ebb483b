"""Writing partitioned tables and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_snapshots(
    df: DataFrame,
    root: str,
    partition_by: str | Sequence[str] = "snapshot_date",
    *,
    format: str = "parquet",
    rebalance: bool = True,
) -> str:
    """Overwrite exactly the partitions that ``df`` holds; all others stay.

    The rebalance hint gathers the rows of a partition into few files, and lets adaptive execution cut a
    partition that is far larger than the others into several tasks.
    """
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    out = df.hint("rebalance", *columns) if rebalance else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns)
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(root)
    return root


def write_predictions(predictions: DataFrame, root: str, format: str = "parquet") -> str:
    return write_snapshots(predictions, root, ["model_name", "snapshot_date"], format=format)


def write_report(report: DataFrame, path: str, order_by: Sequence[str] = (), format: str = "csv") -> str:
    """A small table (one row per month or threshold) as one file. Only its finished rows are gathered; the work
    that makes them keeps its own partitions."""
    one = report.repartition(1)
    writer = (one.sortWithinPartitions(*order_by) if order_by else one).write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write once and read from there: for data that is passed over many times, and to cut a long lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
