"""Reading raw files and partitioned snapshot tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Day = date | str


def _day(value: Day) -> Column:
    return F.lit(value).cast("date")


def read_raw_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None, lineage: bool = False
) -> DataFrame:
    """CSV with a header. With a schema it is read as declared, else every column stays text; types are never
    inferred. ``lineage`` adds the file each row came from and the time it was read."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.csv(paths, header=True, schema=schema, enforceSchema=False)
    if lineage:
        df = df.select("*", F.col("_metadata.file_path").alias("source_file"), F.current_timestamp().alias("ingested_at"))
    return df


def read_table(
    spark: SparkSession,
    root: str,
    *,
    schema: StructType | None = None,
    merge_schema: bool = False,
    missing: str = "raise",
    format: str = "parquet",
) -> DataFrame | None:
    """A partitioned table from its root folder, so that the partition column is there and is pruned.

    ``missing="none"`` gives None for a table that does not exist; ``"raise"`` an error.
    """
    reader = spark.read.format(format)
    if format == "parquet":
        reader = reader.option("mergeSchema", merge_schema)
    else:
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(root)
    except AnalysisException as error:
        absent = error.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
        if absent and missing == "none":
            return None
        if absent:
            raise FileNotFoundError(f"no table at {root}") from error
        raise


def read_paths(spark: SparkSession, paths: str | Sequence[str], root: str) -> DataFrame:
    """Some folders or a glob below a table root, keeping the partition column of the root."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("basePath", root).parquet(*paths)


def at_snapshot(df: DataFrame, day: Day, column: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(column) == _day(day))


def at_snapshots(df: DataFrame, days: Sequence[Day], column: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(column).isin([_day(d) for d in days]))


def up_to(df: DataFrame, day: Day, column: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(column) <= _day(day))


def between(df: DataFrame, first: Day, last: Day, column: str = "snapshot_date") -> DataFrame:
    return df.where(F.col(column).between(_day(first), _day(last)))


def read_asof(spark: SparkSession, root: str, day: Day, *, missing: str = "none", column: str = "snapshot_date") -> DataFrame | None:
    df = read_table(spark, root, missing=missing)
    return None if df is None else up_to(df, day, column)


def union_snapshots(frames: Sequence[DataFrame], strict: bool = False) -> DataFrame:
    """Rows of all frames by column name; unless strict, a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not strict), frames)


def month_starts(df: DataFrame, date_column: str, name: str = "month") -> DataFrame:
    """Every first of month from the month of the earliest date up to the latest date."""
    span = df.agg(F.min(date_column).cast("date").alias("lo"), F.max(date_column).cast("date").alias("hi"))
    months = F.sequence(F.trunc("lo", "MM"), F.col("hi"), F.expr("interval 1 month"))
    return span.where("lo IS NOT NULL").select(F.explode(months).alias(name))


def month_list(first: str, last: str) -> list[date]:
    """First of every month from the month of ``first`` up to ``last``."""
    lo, hi = date.fromisoformat(first), date.fromisoformat(last)
    months = range(lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month)
    return [d for d in (date(m // 12, m % 12 + 1, 1) for m in months) if d <= hi]


def _folders(spark: SparkSession, root: str, column: str) -> dict[date, tuple]:
    """The folders of a table partitioned by a date, with the file system that lists them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in files.listStatus(path)] if files.exists(path) else []
    days = ((p.getName().removeprefix(f"{column}="), p) for p in found if p.getName().startswith(f"{column}="))
    return {date.fromisoformat(d): (files, p) for d, p in days if not d.startswith("__")}


def stored_dates(spark: SparkSession, root: str, column: str = "snapshot_date") -> list[date]:
    """Dates that a partitioned table holds, by the names of its folders: no data file is opened, none is even listed.
    A table that does not exist holds none."""
    return sorted(_folders(spark, root, column))


def modified_dates(spark: SparkSession, root: str, column: str = "snapshot_date") -> dict[date, int]:
    """When each date of a partitioned table was last written, in milliseconds; no data file is opened."""
    folders = _folders(spark, root, column)
    return {d: max((f.getModificationTime() for f in files.listStatus(p)), default=0) for d, (files, p) in folders.items()}


def changed_dates(spark: SparkSession, root: str, watermark: str, column: str = "snapshot_date") -> dict[date, int]:
    """Dates of a table that were written since the watermark last noted them, new ones among them, with the time to note."""
    noted = read_table(spark, watermark, missing="none")
    seen = {} if noted is None else {r[column]: r["modified"] for r in noted.collect()}
    return {d: t for d, t in modified_dates(spark, root, column).items() if t > seen.get(d, -1)}


def missing_dates(source: DataFrame, target: DataFrame | None, column: str = "snapshot_date") -> DataFrame:
    """Dates of the source that the target does not hold yet."""
    dates = source.select(column).where(F.col(column).isNotNull()).distinct()
    if target is None:
        return dates
    return dates.join(target.select(column).distinct(), column, "left_anti")


def on_dates_of(df: DataFrame, dates: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows of some dates. The dates are read first (a calendar is short), so that the filter is a list of
    literals that prunes partitions; a join would read every partition."""
    days = [r[0] for r in dates.select(column).distinct().collect()]
    return df.where(F.col(column).isin(days) if days else F.lit(False))


def only_new(source: DataFrame, target: DataFrame | None, column: str = "snapshot_date") -> DataFrame:
    """Rows of the source whose date the target does not hold yet."""
    return source if target is None else on_dates_of(source, missing_dates(source, target, column), column)
