"""Declared schema of every table. Reading with a schema saves the inference pass and fixes the types of
all snapshots of a table to the same ones."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


CLICK_COLUMNS = tuple(f"fe_{i}" for i in range(1, 21))

LOAN_DAILY = _struct(
    loan_id=StringType(),
    Customer_ID=StringType(),
    loan_start_date=DateType(),
    tenure=IntegerType(),
    installment_num=IntegerType(),
    loan_amt=DoubleType(),
    due_amt=DoubleType(),
    paid_amt=DoubleType(),
    overdue_amt=DoubleType(),
    balance=DoubleType(),
    snapshot_date=DateType(),
)

CLICKSTREAM = _struct(
    Customer_ID=StringType(),
    **{c: IntegerType() for c in CLICK_COLUMNS},
    snapshot_date=DateType(),
)

ATTRIBUTES = _struct(
    Customer_ID=StringType(),
    Name=StringType(),
    SSN=StringType(),
    Age=IntegerType(),
    Occupation=StringType(),
    snapshot_date=DateType(),
)

FINANCIALS = _struct(
    Customer_ID=StringType(),
    Annual_Income=DoubleType(),
    Monthly_Inhand_Salary=DoubleType(),
    Num_Bank_Accounts=IntegerType(),
    Num_Credit_Card=IntegerType(),
    Num_of_Loan=IntegerType(),
    Type_of_Loan=StringType(),
    Delay_from_due_date=IntegerType(),
    Num_of_Delayed_Payment=IntegerType(),
    Changed_Credit_Limit=DoubleType(),
    Credit_Mix=StringType(),
    Outstanding_Debt=DoubleType(),
    Credit_Utilization_Ratio=DoubleType(),
    Credit_History_Age=StringType(),
    Total_EMI_per_month=DoubleType(),
    Payment_Behaviour=StringType(),
    snapshot_date=DateType(),
)

APPLICATIONS = _struct(
    Customer_ID=StringType(),
    application_date=DateType(),
    loan_amt=IntegerType(),
    tenure=IntegerType(),
)

LABELS = _struct(
    loan_id=StringType(),
    Customer_ID=StringType(),
    label=IntegerType(),
    label_def=StringType(),
    snapshot_date=DateType(),
)

PREDICTIONS = _struct(
    Customer_ID=StringType(),
    snapshot_date=DateType(),
    model_name=StringType(),
    model_predictions=DoubleType(),
)

MONITORING = _struct(
    month=DateType(),
    n_samples=LongType(),
    AUC=DoubleType(),
    Gini=DoubleType(),
    KS=DoubleType(),
    Brier=DoubleType(),
    Pred_Mean=DoubleType(),
    Actual_Default_Rate=DoubleType(),
    Default_Rate_Diff=DoubleType(),
)

# Raw table name -> (schema of the cleaned table, columns that identify one row).
SOURCES = {
    "lms_loan_daily": (LOAN_DAILY, ("loan_id", "snapshot_date")),
    "feature_clickstream": (CLICKSTREAM, ("Customer_ID", "snapshot_date")),
    "features_attributes": (ATTRIBUTES, ("Customer_ID", "snapshot_date")),
    "features_financials": (FINANCIALS, ("Customer_ID", "snapshot_date")),
}
