"""Schemas and fixed values.

Everything under "Fixed values" must equal the behaviour being matched
(status sets, level maps, thresholds, labels); it is stated once here and
imported everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# loan_status values that mean "defaulted" and "repaid"; anything else
# (current, grace period, issued, unknown, NULL) is censored -> NULL label.
DEFAULT_STATUSES = (
    "Charged Off",
    "Default",
    "Late (31-120 days)",
    "Late (16-30 days)",
    "Does not meet the credit policy. Status:Charged Off",
)
REPAY_STATUSES = (
    "Fully Paid",
    "Does not meet the credit policy. Status:Fully Paid",
)

# Employment length text -> years.
EMP_LENGTH_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4,
    "5 years": 5, "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9,
    "10+ years": 10,
}

# Raw feature columns selected at ingest, and the label source column.
RAW_FEATURE_COLS = [
    "loan_amnt", "term", "int_rate", "installment",
    "grade", "sub_grade",
    "emp_length", "home_ownership", "annual_inc", "verification_status",
    "purpose", "addr_state", "application_type",
    "dti", "revol_util", "revol_bal",
    "fico_range_low", "fico_range_high",
    "delinq_2yrs", "pub_rec", "pub_rec_bankruptcies",
    "mort_acc", "open_acc", "total_acc",
    "earliest_cr_line", "issue_d",
]
STATUS_COL = "loan_status"

# Curated-table contract.
CONTRACT_NUMERIC = [
    "loan_amnt", "int_rate", "installment", "annual_inc", "dti", "delinq_2yrs",
    "fico_range_low", "fico_range_high", "open_acc", "pub_rec", "revol_bal",
    "revol_util", "total_acc", "mort_acc", "pub_rec_bankruptcies", "issue_year",
]
CONTRACT_STRING = [
    "term", "grade", "sub_grade", "emp_length", "home_ownership",
    "verification_status", "issue_d", "loan_status", "purpose", "addr_state",
    "earliest_cr_line", "application_type",
]
TARGET = "default"
CONTRACT_REQUIRED = [*CONTRACT_NUMERIC, *CONTRACT_STRING, TARGET]

CATEGORICAL_COLS = [
    "grade", "sub_grade", "home_ownership", "verification_status",
    "purpose", "addr_state", "application_type",
]

# Raw columns removed by cleaning.
CLEAN_DROPPED = ["loan_status", "earliest_cr_line", "issue_d", "fico_range_low", "fico_range_high"]

INTERACTION_COLS = [
    "loan_to_income",
    "installment_to_income",
    "int_rate_x_term",
    "fico_dti_risk",
    "revol_util_x_logbal",
    "accounts_per_year",
    "delinq_per_year",
]

# Time split years of the original data (train <= 2016, test >= 2017,
# base <= 2015, calibration = 2016). The driver tables span 1995-2001, so the
# registered queries pass 1998 / 1999 / 2000 as parameters instead.
TRAIN_MAX_YEAR = 2016
TEST_MIN_YEAR = 2017
BASE_MAX_YEAR = 2015
CALIB_YEAR = 2016

# Decision and monitoring constants.
DECISION_THRESHOLD = 0.13
COST_FN = 5.0
COST_FP = 1.0
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25
PSI_MIN_SAMPLES = 1000
PSI_SHARE_FLOOR = 1e-6
GROUP_MIN_ROWS = 100
# float64 machine epsilon used to clip probabilities in log-loss.
LOGLOSS_EPS = 2.220446049250313e-16

# Risk bands by probability: < 0.10 Low, < 0.25 Moderate, < 0.50 Elevated, else High.
RISK_BANDS = [(0.10, "Low risk"), (0.25, "Moderate risk"), (0.50, "Elevated risk")]
RISK_BAND_TOP = "High risk"

# Agreement of two rates means |delta| < 3 pp.
GRADE_AGREE_PP = 0.03

# FICO buckets for the default-rate profile: right-closed bins on these edges.
FICO_EDGES = [600, 650, 680, 700, 720, 750, 850]

# Human-readable feature labels for reason codes (fallback: the feature name).
FEATURE_LABELS = {
    "loan_amnt": "Loan amount",
    "term": "Loan term (months)",
    "int_rate": "Interest rate",
    "installment": "Monthly installment",
    "grade": "LendingClub grade",
    "sub_grade": "LendingClub sub-grade",
    "emp_length": "Employment length",
    "emp_length_missing": "Employment length missing",
    "home_ownership": "Home ownership",
    "annual_inc": "Annual income",
    "verification_status": "Income verification status",
    "purpose": "Loan purpose",
    "addr_state": "State of residence",
    "application_type": "Application type",
    "dti": "Debt-to-income ratio",
    "revol_util": "Revolving utilization",
    "revol_bal": "Revolving balance",
    "fico_mean": "FICO score",
    "delinq_2yrs": "Delinquencies (2yr)",
    "pub_rec": "Public records",
    "pub_rec_bankruptcies": "Bankruptcies",
    "mort_acc": "Mortgage accounts",
    "open_acc": "Open credit lines",
    "total_acc": "Total credit lines",
    "credit_history_years": "Length of credit history",
    "loan_to_income": "Loan-to-income ratio",
    "installment_to_income": "Installment-to-income ratio",
    "int_rate_x_term": "Total interest exposure (rate × term)",
    "fico_dti_risk": "FICO × DTI risk product",
    "revol_util_x_logbal": "Utilization × log(balance)",
    "accounts_per_year": "Account-opening velocity",
    "delinq_per_year": "Delinquency rate (per year of history)",
}

# Hyper-parameter search space and the hand-picked defaults (trial 0).
SEARCH_SPACE = {
    "max_depth": [4, 6, 8],
    "learning_rate": [0.05, 0.10],
    "n_estimators": [200, 400],
    "min_child_weight": [1, 5, 20],
    "subsample": [0.7, 0.9],
    "colsample_bytree": [0.6, 0.9],
    "reg_lambda": [1.0, 5.0],
    "gamma": [0.0, 0.5],
}
DEFAULT_PARAMS = {
    "max_depth": 6,
    "learning_rate": 0.10,
    "n_estimators": 400,
    "min_child_weight": 5,
    "subsample": 0.9,
    "colsample_bytree": 0.8,
    "reg_lambda": 1.0,
    "gamma": 0.0,
}
N_TRIALS = 15
CV_FOLDS = 2
SUBSAMPLE_FRAC = 0.25
RANDOM_STATE = 42

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

_D, _S, _I = T.DoubleType(), T.StringType(), T.IntegerType()

RAW_NUMERIC = [
    "loan_amnt", "int_rate", "installment", "annual_inc", "dti", "delinq_2yrs",
    "fico_range_low", "fico_range_high", "open_acc", "pub_rec", "revol_bal",
    "revol_util", "total_acc", "mort_acc", "pub_rec_bankruptcies",
]


def raw_schema(with_id: bool = True) -> T.StructType:
    """Declared schema of the raw loan file (never inferred)."""
    fields = [T.StructField("application_id", _S)] if with_id else []
    for c in RAW_FEATURE_COLS + [STATUS_COL]:
        fields.append(T.StructField(c, _D if c in RAW_NUMERIC else _S))
    return T.StructType(fields)


# Cleaned v1 feature columns, in model order.
CLEAN_FEATURES_V1 = [
    "loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
    "emp_length", "home_ownership", "annual_inc", "verification_status",
    "purpose", "addr_state", "application_type", "dti", "revol_util",
    "revol_bal", "delinq_2yrs", "pub_rec", "pub_rec_bankruptcies", "mort_acc",
    "open_acc", "total_acc", "emp_length_missing", "credit_history_years",
    "fico_mean",
]
CLEAN_FEATURES_V2 = CLEAN_FEATURES_V1 + INTERACTION_COLS
NUMERIC_FEATURES_V1 = [c for c in CLEAN_FEATURES_V1 if c not in CATEGORICAL_COLS]
NUMERIC_FEATURES_V2 = [c for c in CLEAN_FEATURES_V2 if c not in CATEGORICAL_COLS]

# Scoring-time row rules (field, lower, lower_inclusive, upper, upper_inclusive,
# nullable) for numeric fields, and (field, min_len, max_len, nullable) for text.
NUMERIC_RULES = [
    ("loan_amnt", 0, False, 100_000, True, False),
    ("int_rate", 0, False, 100, True, False),
    ("installment", 0, False, 10_000, True, False),
    ("emp_length", 0, True, 10, True, True),
    ("annual_inc", 0, True, 100_000_000, True, False),
    ("dti", -1, True, 1000, True, True),
    ("revol_util", 0, True, 1000, True, True),
    ("revol_bal", 0, True, 100_000_000, True, False),
    ("fico_mean", 300, True, 850, True, False),
    ("delinq_2yrs", 0, True, 100, True, True),
    ("pub_rec", 0, True, 100, True, True),
    ("pub_rec_bankruptcies", 0, True, 100, True, True),
    ("mort_acc", 0, True, 100, True, True),
    ("open_acc", 0, True, 200, True, True),
    ("total_acc", 0, True, 200, True, True),
    ("credit_history_years", 0, True, 100, True, True),
]
TEXT_RULES = [
    ("application_id", 0, 64, True),
    ("grade", 1, 2, False),
    ("sub_grade", 1, 3, False),
    ("home_ownership", 1, 20, False),
    ("verification_status", 1, 30, False),
    ("purpose", 1, 40, False),
    ("addr_state", 2, 2, False),
    ("application_type", 1, 20, False),
]
ENUM_RULES = [("term", (36, 60), False), ("emp_length_missing", (0, 1), True)]
APPLICATION_FIELDS = ["application_id"] + CLEAN_FEATURES_V1

# Prediction-log record (one JSON line per scored application).
def prediction_log_schema() -> T.StructType:
    feat = T.StructType(
        [T.StructField("application_id", _S)]
        + [T.StructField(c, _S if c in CATEGORICAL_COLS else _D) for c in CLEAN_FEATURES_V1]
    )
    return T.StructType([
        T.StructField("ts", T.TimestampType()),
        T.StructField("application_id", _S),
        T.StructField("p_default", _D),
        T.StructField("decision", _S),
        T.StructField("threshold", _D),
        T.StructField("model", _S),
        T.StructField("features", feat),
    ])
