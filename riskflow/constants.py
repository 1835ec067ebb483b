"""Category lists, tokens, rates and thresholds that results depend on."""

# --- fixed values: categories ---
# Low before high spending and small before large payments, good before bad credit, else by name; the order only decides
# that of the flag columns.
PAYMENT_BEHAVIOURS = (
    "Low_spent_Small_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Large_value_payments",
    "High_spent_Small_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Large_value_payments",
)
CREDIT_MIXES = ("Good", "Standard", "Bad")
LOAN_TYPES = (
    "Auto Loan",
    "Credit-Builder Loan",
    "Debt Consolidation Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Payday Loan",
    "Personal Loan",
    "Student Loan",
)
BAD_TOKENS = ("-", "?", "n/a", "na", "nan", "none", "null", "undefined", "unknown")
UNKNOWN = "Unknown"

# --- fixed values: bands ---
AGE_CUTS = (25, 35, 45, 55)
AGE_LABELS = ("18-24", "25-34", "35-44", "45-54", "55+")
INCOME_CUTS = (20_000, 50_000, 100_000)
INCOME_LABELS = ("0-20k", "20-50k", "50-100k", "100k+")
DTI_EDGES = (0.0, 0.2, 0.36, 0.43, 1.0, 10.0)
DTI_LABELS = ("Very Low (<20%)", "Low (20-36%)", "Moderate (36-43%)", "High (43-100%)", "Very High (>100%)")

# --- fixed values: text ---
EXPONENT = r"^[+-]?[0-9]*\.?[0-9]+[eE][+-]?[0-9]+$"  # numbers as Spark's CSV writer prints doubles from 1e7

# --- fixed values: look-back horizons in days ---
DELAY_HORIZONS = {"3m": 90, "6m": 180, "12m": 365}
CLICK_HORIZONS = {"7d": 7, "30d": 30}
LIMIT_HORIZONS = {"3m": 90, "6m": 180}

# --- fixed values: loan request defaults and label definition ---
REQUEST_AMOUNT = 10_000
REQUEST_TENURE = 10
ANNUAL_RATE = 0.12
DPD_THRESHOLD = 30

# --- fixed values: decision analysis ---
THRESHOLDS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.50)
AVERAGE_LOAN = 10_000
LOSS_GIVEN_DEFAULT = 0.70
CONSERVATIVE_RATE = 0.03
BALANCED_THRESHOLD = 0.15
GROWTH_RATE = 0.05
OVERFIT_GAP = 0.05

# --- fixed values: training ---
TRAIN_RATIO = 0.8
SPLIT_SEED = 88
TRAIN_TEST_MONTHS = 12
OOT_MONTHS = 2
SEARCH_SEED = 42
FOLDS = 3

KEYS = ("loan_id", "Customer_ID", "application_date", "snapshot_date")
