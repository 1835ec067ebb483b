from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import applications as A
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query
from riskflow.session import scratch_dir
from riskflow.sources import sinks, tables
from riskflow.streaming.incremental import refresh_snapshots

# ---- applications ----


def _loans(t: Tables) -> DataFrame:
    return t["orders"].select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("Customer_ID"),
        F.to_date("o_orderdate").alias("loan_start_date"),
        F.col("o_totalprice").alias("loan_amt"),
        F.lit(10).alias("tenure"),
    )


@query(
    "application_store",
    """SELECT DISTINCT o_custkey AS "Customer_ID", CAST(o_orderdate AS DATE) AS application_date, 10000 AS loan_amt, 10 AS tenure
    FROM orders""",
)
def application_store(t: Tables) -> DataFrame:
    return A.application_store(_loans(t))


@query(
    "applications_latest",
    """SELECT DISTINCT o_custkey AS "Customer_ID", CAST(o_orderdate AS DATE) AS application_date, 10000 AS loan_amt, 10 AS tenure
    FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)""",
)
def applications_latest(t: Tables) -> DataFrame:
    return A.select_dates(A.application_store(_loans(t)))


@query(
    "applications_range",
    """SELECT DISTINCT o_custkey AS "Customer_ID", CAST(o_orderdate AS DATE) AS application_date, 10000 AS loan_amt, 10 AS tenure
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-05-31'""",
)
def applications_range(t: Tables) -> DataFrame:
    return A.select_dates(A.application_store(_loans(t)), "range", "1996-03-01", "1996-05-31")


@query(
    "training_applications",
    """SELECT DISTINCT o_orderkey AS loan_id, o_custkey AS "Customer_ID", o_totalprice AS loan_amt, 10 AS tenure,
    CAST(o_orderdate AS DATE) AS application_date FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-12-31'""",
)
def training_applications(t: Tables) -> DataFrame:
    return A.training_applications(_loans(t), "1998-12-31")


@query(
    "first_snapshots",
    f"""WITH {V.LOAN_L} SELECT loan_id, snapshot_date, mob, due_amt FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY loan_id
      ORDER BY snapshot_date, mob, due_amt) AS rn FROM loan_l) WHERE rn = 1""",
)
def first_snapshots(t: Tables) -> DataFrame:
    return A.first_snapshots(V.loan_l(t), tie=("mob", "due_amt")).select("loan_id", "snapshot_date", "mob", "due_amt")


# ---- partitioned tables ----


def _monthly(t: Tables) -> DataFrame:
    return t["orders"].select(
        "o_orderkey", "o_custkey", "o_totalprice", F.trunc(F.to_date("o_orderdate"), "MM").alias("snapshot_date")
    )


_MONTHLY = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS snapshot_date FROM orders"""


@query(
    "write_dynamic_overwrite",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-06-30' THEN o_totalprice * 2
    ELSE o_totalprice END AS o_totalprice, snapshot_date FROM ({_MONTHLY})""",
)
def write_dynamic_overwrite(t: Tables) -> DataFrame:
    """All months are written, then six of them again with other values; the others must survive."""
    root = scratch_dir(t.spark, "orders_by_month")
    sinks.write_snapshots(_monthly(t), root)
    again = tables.between(_monthly(t), "1997-01-01", "1997-06-30").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.write_snapshots(again, root)
    return tables.read_table(t.spark, root)


@query("incremental_dates", _MONTHLY)
def incremental_dates(t: Tables) -> DataFrame:
    """A target that holds the months up to 1998 gets exactly the missing ones, told by the folders of both tables."""
    source, root = scratch_dir(t.spark, "orders_source"), scratch_dir(t.spark, "orders_incremental")
    sinks.write_snapshots(_monthly(t), source)
    stored = tables.read_table(t.spark, source)
    sinks.write_snapshots(tables.up_to(stored, "1998-12-31"), root)
    held = set(tables.stored_dates(t.spark, root))
    missing = [d for d in tables.stored_dates(t.spark, source) if d not in held]
    sinks.write_snapshots(tables.at_snapshots(stored, missing), root)
    return tables.read_table(t.spark, root)


@query(
    "missing_dates",
    """SELECT DISTINCT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS snapshot_date FROM orders
    WHERE o_orderdate >= DATE '1999-01-01'""",
)
def missing_dates(t: Tables) -> DataFrame:
    return tables.missing_dates(_monthly(t), tables.up_to(_monthly(t), "1998-12-31"))


@query("stream_refresh", _MONTHLY)
def stream_refresh(t: Tables) -> DataFrame:
    """Files arrive in two lots; months touched by the second lot are rebuilt from all their files."""
    base = scratch_dir(t.spark, "orders_stream")
    rows = _monthly(t)
    for lot in (F.col("o_totalprice") < 100_000, F.col("o_totalprice") >= 100_000):
        rows.where(lot).write.mode("append").parquet(f"{base}/source")
        refresh_snapshots(
            t.spark, f"{base}/source", rows.schema, f"{base}/target", f"{base}/checkpoint", lambda df: df.distinct()
        )
    return tables.read_table(t.spark, f"{base}/target")


@query(
    "csv_round_trip",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS snapshot_date, 1 AS from_root FROM orders""",
)
def csv_round_trip(t: Tables) -> DataFrame:
    """Raw text files with a header, read without inference; every row knows its file."""
    root = scratch_dir(t.spark, "orders_csv")
    _monthly(t).drop("o_totalprice").write.option("header", True).csv(root)
    raw = tables.read_raw_csv(t.spark, root, lineage=True)
    return raw.select(
        "o_orderkey",
        "o_custkey",
        F.col("snapshot_date").try_cast("date").alias("snapshot_date"),
        F.col("source_file").contains(root.rsplit("/", 1)[-1]).cast("int").alias("from_root"),
    )


@query(
    "read_asof",
    f"SELECT * FROM ({_MONTHLY}) WHERE snapshot_date <= DATE '1996-06-01'",
)
def read_asof(t: Tables) -> DataFrame:
    root = scratch_dir(t.spark, "orders_asof")
    sinks.write_snapshots(_monthly(t), root)
    return tables.read_asof(t.spark, root, "1996-06-01")


@query(
    "read_snapshot_paths",
    f"SELECT * FROM ({_MONTHLY}) WHERE snapshot_date IN (DATE '1996-06-01', DATE '1996-07-01', DATE '1999-01-01')",
)
def read_snapshot_paths(t: Tables) -> DataFrame:
    """Two folders by path and one by date keep their partition column."""
    root = scratch_dir(t.spark, "orders_paths")
    sinks.write_snapshots(_monthly(t), root)
    some = tables.read_paths(t.spark, [f"{root}/snapshot_date=1996-0{m}-01" for m in (6, 7)], root)
    one = tables.at_snapshot(tables.read_table(t.spark, root), "1999-01-01")
    return tables.union_snapshots([some, one], strict=True)


@query(
    "merged_schema",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN snapshot_date > DATE '1997-12-31' THEN o_totalprice END AS o_totalprice, snapshot_date
    FROM ({_MONTHLY})""",
)
def merged_schema(t: Tables) -> DataFrame:
    """Old months lack a column that new months have."""
    root = scratch_dir(t.spark, "orders_merge")
    sinks.write_snapshots(tables.up_to(_monthly(t), "1997-12-31").drop("o_totalprice"), root)
    sinks.write_snapshots(_monthly(t).where(F.col("snapshot_date") > F.lit("1997-12-31").cast("date")), root)
    return tables.read_table(t.spark, root, merge_schema=True).select("o_orderkey", "o_custkey", "o_totalprice", "snapshot_date")
