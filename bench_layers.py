"""Time the layers over 24 months, from raw text files to the label store.

The raw files are derived from the test tables: every order of 1997 and 1998 is a loan with three monthly
snapshots, every line of it a clickstream row, and customers have attributes and financials in each month of an
order. At the scale of the default folder that is some 5,600 loan rows and 7,500 clickstream rows a month.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.constants import CREDIT_MIXES, LOAN_TYPES, PAYMENT_BEHAVIOURS
from riskflow.plans import layers
from riskflow.schemas import SOURCES
from riskflow.session import scratch_dir


def _choice(values, x):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (x % len(values) + 1).cast("int"))


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    month = F.trunc(F.to_date("o_orderdate"), "MM")
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("month", month)
    orders = orders.where(F.col("month").between("1997-01-01", "1998-12-01"))
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    customer = F.col("o_custkey").cast("string").alias("Customer_ID")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    late = F.when(key % 7 == 0, 1000 * F.col("mob")).otherwise(0)
    loans = orders.withColumn("mob", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        key.alias("loan_id"), customer, F.col("month").alias("loan_start_date"), F.lit(10).alias("tenure"),
        F.col("mob").alias("installment_num"), F.lit(10000).alias("loan_amt"), F.lit(1000).alias("due_amt"),
        (1000 - F.least(late, F.lit(1000))).alias("paid_amt"), late.alias("overdue_amt"), F.lit(9000).alias("balance"),
        F.add_months("month", F.col("mob")).alias("snapshot_date"),
    )
    clicks = lines.join(orders, key == F.col("l_orderkey")).select(
        customer,
        *[(F.col("l_quantity") * i % 97 - 10).cast("int").alias(f"fe_{i}") for i in range(1, 21)],
        F.col("month").alias("snapshot_date"),
    )
    seen = orders.groupBy("o_custkey", "month").agg(F.max("o_totalprice").alias("price"))
    attributes = seen.select(
        customer, F.concat(F.lit("Name "), cust).alias("Name"), F.lit("1-2-3").alias("SSN"),
        F.concat(cust % 80, F.lit("_")).alias("Age"), _choice(("Lawyer", "Doctor", "Teacher", "unknown"), cust).alias("Occupation"),
        F.col("month").alias("snapshot_date"),
    )
    financials = seen.select(
        customer, F.concat(F.round("price", 2).cast("string"), F.lit("_")).alias("Annual_Income"),
        (cust % 9).alias("Num_of_Loan"), F.concat(_choice(LOAN_TYPES, cust), F.lit(", and "), _choice(LOAN_TYPES, cust + 3)).alias("Type_of_Loan"),
        (cust % 30).alias("Num_of_Delayed_Payment"), (F.col("price") % 11).alias("Changed_Credit_Limit"),
        _choice(CREDIT_MIXES, cust).alias("Credit_Mix"), (F.col("price") / 7).alias("Outstanding_Debt"),
        F.concat(cust % 30, F.lit(" Years and "), cust % 12, F.lit(" Months")).alias("Credit_History_Age"),
        _choice((*PAYMENT_BEHAVIOURS, "!@9#%8"), cust).alias("Payment_Behaviour"), F.col("month").alias("snapshot_date"),
    )
    return dict(zip(SOURCES, (loans, clicks, attributes, financials)))


def run(spark: SparkSession, folder: str) -> dict[str, float]:
    base = scratch_dir(spark, "layers")
    for name, df in raw_tables(spark, folder).items():
        df.write.option("header", True).csv(f"{base}/raw/{name}.csv")
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("layers_bronze", lambda: [layers.bronze(spark, f"{base}/raw/{t}.csv", t, base) for t in SOURCES])
    timed("layers_silver", lambda: [layers.silver(spark, t, base) for t in SOURCES])
    timed("layers_applications", lambda: layers.application_table(spark, base, "all"))
    timed("layers_features", lambda: layers.feature_table(spark, base))
    timed("layers_labels", lambda: layers.label_table(spark, base))
    return seconds
