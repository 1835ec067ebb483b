"""Process files that arrived since the last run, as a file stream that stops when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskflow.sources.sinks import write_snapshots
from riskflow.sources.tables import on_dates_of, read_table

BATCH = "batch"


def refresh_snapshots(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame],
    *,
    landed: str | None = None,
    date: str = "snapshot_date",
    format: str = "parquet",
) -> None:
    """Rebuild every snapshot that new files touch, from all rows of that snapshot.

    New rows land in a table by (date, batch), beside the target unless ``landed`` says where. A batch that is repeated after a
    failure replaces its own folders there. The dates of the batch are then rebuilt from their landed folders alone,
    so a file that comes late for a date gives the same table as reading everything at once, and neither old
    source files nor folders of other dates are read again. Rows without date are left out.
    """
    options = {"header": "true"} if format == "csv" else {}
    stream = spark.readStream.schema(schema).options(**options).format(format).load(source)
    landing = landed or f"{target.rstrip('/')}.landed"
    columns = schema.fieldNames()
    stored = StructType([*schema.fields, StructField(BATCH, LongType())])

    def rebuild(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        dated = batch.where(F.col(date).isNotNull()).withColumn(BATCH, F.lit(number))
        batch.persist()
        try:
            if dated.isEmpty():
                return
            write_snapshots(dated, landing, [date, BATCH])
            rows = on_dates_of(read_table(session, landing, schema=stored), dated, date)
            write_snapshots(clean(rows.select(*columns)), target, date)
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
