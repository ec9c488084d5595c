"""Check configuration.

Every column name, threshold and valid-value set used by the checks is a
parameter of :class:`CheckConfig`. :data:`DEFAULT` holds the values of the
original e-commerce monitor, so a snapshot with that layout can be checked
without any set-up; other tables build their own config with
``dataclasses.replace`` or a fresh ``CheckConfig(...)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values (must equal the original monitor's for matching results)
# --------------------------------------------------------------------------
# Expected snapshot columns, in order.
EXPECTED_COLUMNS = (
    "Order ID", "Order Date", "Customer Name", "Region",
    "City", "Category", "Sub-Category", "Product Name",
    "Quantity", "Unit Price", "Discount", "Sales",
    "Profit", "Payment Mode",
)
# Allowed dtype names per column (pandas dtype spelling).
EXPECTED_DTYPES = {
    "Order ID": ("int64", "int32"),
    "Quantity": ("int64", "int32"),
    "Unit Price": ("int64", "int32", "float64"),
    "Discount": ("int64", "int32", "float64"),
    "Sales": ("float64", "float32"),
    "Profit": ("float64", "float32"),
}
# Inclusive numeric ranges.
NUMERIC_RANGES = {
    "Quantity": (1, 5),
    "Discount": (0, 20),
    "Unit Price": (100, 100000),
    "Sales": (0, 500000),
    "Profit": (-50000, 100000),
}
# Regex patterns per string column.
PATTERNS = {
    "Order Date": r"^\d{4}-\d{2}-\d{2}$",
    "Customer Name": r"^[A-Za-z]+ [A-Za-z]+$",
}
VALID_REGIONS = ("North", "South", "East", "West")
VALID_PAYMENT_MODES = ("Debit Card", "Credit Card", "UPI", "Net Banking", "COD")
VALID_CATEGORIES = (
    "Books", "Groceries", "Kitchen", "Clothing", "Furniture",
    "Beauty", "Home Decor", "Electronics", "Sports", "Toys",
)
# Column roles and thresholds of the checks.
IGNORED_EXTRA_COLUMNS = ("ingestion_timestamp",)
ID_COLUMN = "Order ID"
IQR_COLUMNS = ("Sales", "Profit", "Unit Price", "Quantity")
ZSCORE_COLUMNS = ("Sales", "Profit", "Unit Price")
ZSCORE_THRESHOLD = 3.0
SKEW_COLUMNS = ("Sales", "Profit", "Unit Price", "Quantity")
SKEW_THRESHOLD = 2.0
DATE_COLUMN = "Order Date"
FRESHNESS_MAX_DAYS = 30
MAX_GAP_DAYS = 7
VOLUME_THRESHOLD_PCT = 30.0
MISSING_MAX_PCT = 5.0
PSI_COLUMN = "Sales"
PSI_BINS = 10
CORR_COLUMNS = ("Sales", "Profit", "Unit Price", "Quantity", "Discount")
CORR_THRESHOLD = 0.2
ENTROPY_COLUMN = "Category"
ENTROPY_THRESHOLD = 0.5
POSITIVE_COLUMN = "Sales"
LE_PAIR = ("Profit", "Sales")
BOUNDED_COLUMN = ("Discount", 0, 20)
RULE_NAMES = ("sales_positive", "profit_le_sales", "discount_range")
PARENT_COLUMN, CHILD_COLUMN = "Category", "Sub-Category"
AMOUNT_COLUMN, QUANTITY_COLUMN, PRICE_COLUMN, DISCOUNT_COLUMN = "Sales", "Quantity", "Unit Price", "Discount"
AMOUNT_TOLERANCE_PCT = 1.0
# Check weights for the quality score (unknown checks weigh 3).
CHECK_WEIGHTS = {
    "null_value_detection": 10,
    "duplicate_detection": 8,
    "data_type_validation": 5,
    "column_existence": 7,
    "range_validation": 6,
    "regex_pattern_validation": 4,
    "outlier_detection_iqr": 5,
    "outlier_detection_zscore": 4,
    "schema_change_detection": 7,
    "data_freshness": 6,
    "volume_anomaly": 6,
    "missing_value_percentage": 5,
    "psi_distribution_drift": 5,
    "correlation_drift": 4,
    "data_skew_detection": 3,
    "entropy_change": 3,
    "time_gap_detection": 3,
    "business_rule_validation": 8,
    "uniqueness_constraints": 6,
    "referential_consistency": 4,
    "sales_calculation_check": 5,
}
DEFAULT_WEIGHT = 3
# Checks whose failure raises the rule-based anomaly flag.
CRITICAL_CHECKS = (
    "null_value_detection",
    "duplicate_detection",
    "schema_change_detection",
    "volume_anomaly",
    "business_rule_validation",
    "outlier_detection_zscore",
)
# The 21 checks in run order.
CHECK_ORDER = (
    "null_value_detection",
    "duplicate_detection",
    "data_type_validation",
    "column_existence",
    "range_validation",
    "regex_pattern_validation",
    "outlier_detection_iqr",
    "outlier_detection_zscore",
    "schema_change_detection",
    "data_freshness",
    "volume_anomaly",
    "missing_value_percentage",
    "psi_distribution_drift",
    "correlation_drift",
    "data_skew_detection",
    "entropy_change",
    "time_gap_detection",
    "business_rule_validation",
    "uniqueness_constraints",
    "referential_consistency",
    "sales_calculation_check",
)
# Text cells read as missing by the original CSV loader (pandas defaults).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
# Date formats tried on text, in order of preference.
DATE_FORMATS = (
    "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "MM-dd-yyyy", "yyyy/MM/dd", "dd.MM.yyyy", "dd MMM yyyy",
    "MMM dd, yyyy", "yyyyMMdd", "dd/MM/yyyy HH:mm", "MM/dd/yyyy HH:mm", "dd/MM/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm:ss",
)
# Metric-history features for the isolation forest, in order.
FEATURE_COLUMNS = (
    "row_count",
    "null_percentage",
    "duplicate_count",
    "quality_score",
    "drift_score",
    "outlier_count",
    "volume_change_pct",
    "max_skewness",
    "entropy_delta",
    "correlation_drift",
)
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class SetRule:
    """Business rule: ``column`` must hold one of ``values`` (null is invalid)."""

    name: str
    column: str
    values: tuple


@dataclass(frozen=True)
class CheckConfig:
    """Column roles and thresholds for the 21 checks."""

    expected_columns: tuple = EXPECTED_COLUMNS
    expected_dtypes: dict = field(default_factory=lambda: dict(EXPECTED_DTYPES))
    ignored_extra_columns: tuple = IGNORED_EXTRA_COLUMNS
    numeric_ranges: dict = field(default_factory=lambda: dict(NUMERIC_RANGES))
    patterns: dict = field(default_factory=lambda: dict(PATTERNS))
    # duplicate / uniqueness key (None: skipped)
    id_column: str | None = ID_COLUMN
    # outliers
    iqr_columns: tuple = IQR_COLUMNS
    zscore_columns: tuple = ZSCORE_COLUMNS
    zscore_threshold: float = ZSCORE_THRESHOLD
    # skew
    skew_columns: tuple = SKEW_COLUMNS
    skew_threshold: float = SKEW_THRESHOLD
    # dates
    date_column: str | None = DATE_COLUMN
    freshness_max_days: int = FRESHNESS_MAX_DAYS
    max_gap_days: int = MAX_GAP_DAYS
    # volume / missing
    volume_threshold_pct: float = VOLUME_THRESHOLD_PCT
    missing_max_pct: float = MISSING_MAX_PCT
    # drift
    psi_column: str | None = PSI_COLUMN
    psi_bins: int = PSI_BINS
    corr_columns: tuple = CORR_COLUMNS
    corr_threshold: float = CORR_THRESHOLD
    entropy_column: str | None = ENTROPY_COLUMN
    entropy_threshold: float = ENTROPY_THRESHOLD
    # business rules
    positive_column: str | None = POSITIVE_COLUMN
    le_pair: tuple | None = LE_PAIR  # first <= second
    bounded_column: tuple | None = BOUNDED_COLUMN
    rule_names: tuple = RULE_NAMES
    set_rules: tuple = (
        SetRule("valid_region", "Region", VALID_REGIONS),
        SetRule("valid_payment_mode", "Payment Mode", VALID_PAYMENT_MODES),
        SetRule("valid_category", "Category", VALID_CATEGORIES),
    )
    # parent/child consistency
    parent_column: str | None = PARENT_COLUMN
    child_column: str | None = CHILD_COLUMN
    # amount = quantity * price * (1 - discount / 100)
    amount_column: str | None = AMOUNT_COLUMN
    quantity_column: str | None = QUANTITY_COLUMN
    price_column: str | None = PRICE_COLUMN
    discount_column: str | None = DISCOUNT_COLUMN
    amount_tolerance_pct: float = AMOUNT_TOLERANCE_PCT
    # score
    weights: dict = field(default_factory=lambda: dict(CHECK_WEIGHTS))
    default_weight: int = DEFAULT_WEIGHT
    critical_checks: tuple = CRITICAL_CHECKS
    # exact full-row duplicate count (off: duplicate_rows is not computed)
    row_duplicates: bool = True
    # quartiles for the IQR check, the same way at every size: "select" (exact
    # by rank selection, bounded memory, a few narrow passes); the caller may
    # ask for "exact" (Spark percentile, one pass; keeps a value map per
    # snapshot) or "approx" (percentile_approx sketch)
    quantiles: str = "select"
    approx_accuracy: int = 100000
    # correlated columns from which on all pairs are summed by matrix products
    # instead of by expressions of their own
    gram_columns: int = 12
    # per-snapshot rows up to which predecessors are found in one window task
    window_rows: int = 20_000
    # text columns whose values are to parse as types: column -> ("int64", "float64", "date", ...)
    value_types: dict = field(default_factory=dict)
    # further keys, each a tuple of columns, that are to be unique in a snapshot
    unique_keys: tuple = ()
    # formats that dates in text are tried with, besides ISO; each column's
    # most frequent one is used for all of its values
    date_formats: tuple = DATE_FORMATS

    def weight(self, check: str) -> int:
        return self.weights.get(check, self.default_weight)


DEFAULT = CheckConfig()


def blank_config(**roles) -> CheckConfig:
    """A config with every column role switched off, then ``roles`` set.
    Used to point the checks at tables of another layout."""
    off = dict(expected_columns=(), expected_dtypes={}, numeric_ranges={}, patterns={},
               id_column=None, iqr_columns=(), zscore_columns=(), skew_columns=(),
               date_column=None, psi_column=None, corr_columns=(), entropy_column=None,
               positive_column=None, le_pair=None, bounded_column=None, set_rules=(),
               parent_column=None, child_column=None, amount_column=None,
               quantity_column=None, price_column=None, discount_column=None)
    off.update(roles)
    return CheckConfig(**off)
