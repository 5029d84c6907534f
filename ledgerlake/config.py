"""Names, thresholds and labels shared by every stage.

Fixed values: the entries in the block marked FIXED VALUES below must stay
equal to the behaviour we reproduce (column names, defaults, labels,
thresholds). They are listed plainly, in natural order, in one place.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced pipeline's behaviour)
# ---------------------------------------------------------------------------

# Columns that must be non-NULL for a row to survive cleaning.
MANDATORY_COLS = ["Order ID", "Order Date", "Sales", "Profit", "Discount", "Category", "Region"]

# Defaults for non-critical columns.
FILL_DEFAULTS = {
    "Postal Code": "00000",
    "Ship Mode": "Standard Class",
    "Customer Name": "Unknown Customer",
    "Salesperson": "Unassigned",
    "Return Reason": "Not Returned",
    "Target_Sales": 0,
}

# Text columns that are trimmed and title-cased.
TEXT_COLS = ["Region", "Category", "Sub-Category", "Segment", "Ship Mode", "State", "City", "Country"]

# Date columns and the one format they are parsed with.
DATE_COLS = ["Order Date", "Ship Date"]
DATE_FORMAT = "M/d/yyyy"

# Numeric coercions applied in silver.
DOUBLE_COLS = ["Sales", "Profit", "Discount"]
INT_COLS = ["Quantity", "Row ID"]

# Natural key used to drop duplicate rows in silver.
DEDUP_KEY = ["Order ID", "Product ID", "Source_Year"]
# Key used by the duplicate-rate check (differs on purpose: order year).
DUPLICATE_CHECK_KEY = ["Order ID", "Product ID", "Order_Year"]

# Columns added in silver.
DERIVED_COLS = [
    "Profit_Margin_Pct",
    "Discount_Amount",
    "Is_Loss",
    "Order_Year",
    "Order_Month",
    "Order_Quarter",
    "Shipping_Days",
]

# Discount buckets: (inclusive upper bound, label); first entry is "== 0".
DISCOUNT_BUCKETS = [
    (0.0, "1. No Discount"),
    (0.10, "2. 1-10%"),
    (0.20, "3. 11-20%"),
    (0.30, "4. 21-30%"),
    (0.40, "5. 31-40%"),
    (0.50, "6. 41-50%"),
]
DISCOUNT_BUCKET_OVERFLOW = "7. 51%+"

# Return reasons.
RETURN_REASONS = [
    "Wrong Item",
    "Defective Product",
    "Changed Mind",
    "Better Price Found",
    "Damaged in Shipping",
]
NOT_RETURNED = "Not Returned"

# Sales representatives per region (region, name, target).
REFERENCE_SALESPEOPLE = [
    ("East", "Alex Johnson", 250000),
    ("West", "Maria Chen", 300000),
    ("Central", "Robert Smith", 200000),
    ("South", "Emily Davis", 180000),
]

# Per-year scaling factors (sales, profit, quantity); unknown years use 1.0.
YEAR_MULTIPLIERS = {
    2019: (0.82, 0.78, 0.85),
    2020: (0.91, 0.75, 0.88),
    2021: (1.05, 0.95, 1.02),
    2022: (1.12, 1.08, 1.10),
    2023: (1.20, 1.15, 1.18),
}

# Expected coverage used by the dashboard checks.
EXPECTED_YEARS = [2019, 2020, 2021, 2022, 2023]
EXPECTED_REGIONS = ["East", "West", "Central", "South"]
EXPECTED_CATEGORIES = ["Furniture", "Office Supplies", "Technology"]

# Layer tags and check categories.
LAYER_BRONZE, LAYER_SILVER, LAYER_GOLD = "BRONZE", "SILVER", "GOLD"
CAT1 = "Category 1: Data Accuracy & Consistency"
CAT2 = "Category 2: Sales & Profit Calculations"
CAT3 = "Category 3: Dashboard Data Verification"
STATUS_ORDER = ["FAIL", "WARN", "PASS"]

# Gold mart names.
MART_NAMES = [
    "sales_trend",
    "category_performance",
    "regional_performance",
    "loss_making_products",
    "discount_impact",
    "executive_kpis",
]

# Defect injection rates (fractions).
INJECT_NULL_PCT = 0.02
INJECT_DUPLICATE_PCT = 0.01
INJECT_CASE_PCT = 0.03
INJECT_DISCOUNT_PCT = 0.01
RETURN_SAMPLE_PCT = 0.10
RANDOM_SEED = 42

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    """Quality thresholds, in percent."""

    min_retention_pct: float = 95.0
    max_null_pct: float = 5.0
    max_duplicate_pct: float = 2.0
    max_variance_pct: float = 5.0


@dataclass(frozen=True)
class Coverage:
    """What the dashboard checks expect to find in the marts."""

    years: list[int] = field(default_factory=lambda: list(EXPECTED_YEARS))
    regions: list[str] = field(default_factory=lambda: list(EXPECTED_REGIONS))
    categories: list[str] = field(default_factory=lambda: list(EXPECTED_CATEGORIES))
    buckets: list[str] = field(
        default_factory=lambda: [label for _, label in DISCOUNT_BUCKETS] + [DISCOUNT_BUCKET_OVERFLOW]
    )
