"""Business rules as Column expressions.

FIXED VALUES: the labels, thresholds, texts and keywords below must equal the
published semantics for results to match. They are listed plainly, in the
order in which the rules apply (first match wins).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import first_match

# ---------------------------------------------------------------- fixed values
# Transaction status codes of the order table and their status names.
STATUS_NAMES = {"F": "Completed", "O": "Pending", "P": "Processing"}
COMPLETED = "Completed"

# CLV segments by global percentile of estimated_clv (>= p80, >= p60, >= p40).
CLV_SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists", "New Customers"]

# Recommended action per RFM segment; any other segment gets the default.
RFM_ACTIONS = [
    ("Champions", "Reward them. They can become advocates."),
    ("Loyal Customers", "Upsell higher value products."),
    ("New Customers", "Provide onboarding support."),
    ("At Risk", "Send personalized reactivation campaigns."),
    ("Cannot Lose Them", "Win them back via renewals or newer products."),
]
RFM_DEFAULT_ACTION = "Re-engage with special offers."

# Churn: recommended intervention per risk level.
CHURN_INTERVENTIONS = [
    ("Critical", "Immediate personal outreach + special offer"),
    ("High", "Targeted email campaign + discount"),
    ("Medium", "Newsletter + product recommendations"),
]
CHURN_DEFAULT_INTERVENTION = "Standard marketing communications"

# Error severity by lower-cased keyword, first tier wins; else LOW.
SEVERITY_KEYWORDS = [
    ("CRITICAL", ["out of memory", "java heap space", "metaspace"]),
    ("HIGH", ["s3", "access denied", "connection refused"]),
    ("MEDIUM", ["data quality", "schema mismatch", "null pointer"]),
]
SEVERITY_DEFAULT = "LOW"
# Recovery route by lower-cased keyword, in order; else none (null).
RECOVERY_ROUTES = [
    ("memory", "memory_error"),
    ("s3", "s3_access_error"),
    ("timeout", "network_timeout"),
    ("data quality", "data_quality_failure"),
]
# Suggestions per error type; any other type gets the default.
ERROR_SUGGESTIONS = [
    ("OutOfMemoryError", "Increase Spark executor memory; Reduce data partition size; "
                         "Use more efficient serialization"),
    ("ConnectionError", "Check network connectivity; Verify service endpoints; "
                        "Implement retry logic"),
    ("FileNotFoundError", "Verify file paths and permissions; Check if data source is "
                          "available; Implement fallback data sources"),
]
DEFAULT_SUGGESTION = "Contact system administrator"

# Quality-check defaults: null share, duplicate share, outlier sigma.
NULL_THRESHOLD = 0.05
DUPLICATE_THRESHOLD = 0.01
OUTLIER_SIGMA = 3.0
NUMERIC_STRING_PATTERN = r"^\d+\.?\d*$"
# -----------------------------------------------------------------------------


def status_name(code: Column) -> Column:
    return first_match([(code == k, v) for k, v in STATUS_NAMES.items()], F.lit(None))


# Fixed values below this line: thresholds and scores as they apply, first match wins.
def clv_segment(clv: Column, p80: Column, p60: Column, p40: Column) -> Column:
    return first_match(
        [(clv >= p80, CLV_SEGMENTS[0]), (clv >= p60, CLV_SEGMENTS[1]),
         (clv >= p40, CLV_SEGMENTS[2])],
        CLV_SEGMENTS[3],
    )


def score_low_is_good(x: Column, q: Column) -> Column:
    """5..1 where a value at or below the 20th percentile scores 5 (recency)."""
    return first_match([(x <= q[0], 5), (x <= q[1], 4), (x <= q[2], 3), (x <= q[3], 2)], 1)


def score_high_is_good(x: Column, q: Column) -> Column:
    """5..1 where a value at or above the 80th percentile scores 5."""
    return first_match([(x >= q[3], 5), (x >= q[2], 4), (x >= q[1], 3), (x >= q[0], 2)], 1)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "New Customers"),
            ((r >= 3) & (f <= 2) & (m >= 3), "Potential Loyalists"),
            ((r <= 2) & (f >= 3) & (m >= 3), "At Risk"),
            ((r <= 2) & (f <= 2) & (m >= 3), "Cannot Lose Them"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Hibernating"),
        ],
        "Others",
    )


def rfm_action(segment: Column) -> Column:
    return first_match([(segment == s, a) for s, a in RFM_ACTIONS], RFM_DEFAULT_ACTION)


def recency_risk(days: Column) -> Column:
    return first_match([(days > 90, "High"), (days > 60, "Medium"), (days > 30, "Low")],
                       "Very Low")


def frequency_risk(orders: Column) -> Column:
    return first_match([(orders == 1, "High"), (orders <= 3, "Medium")], "Low")


def engagement_risk(categories: Column) -> Column:
    return first_match([(categories == 1, "High"), (categories <= 2, "Medium")], "Low")


def churn_level(score: Column) -> Column:
    return first_match([(score >= 4, "Critical"), (score >= 2, "High"), (score >= 1, "Medium")],
                       "Low")


def churn_intervention(level: Column) -> Column:
    return first_match([(level == k, v) for k, v in CHURN_INTERVENTIONS],
                       CHURN_DEFAULT_INTERVENTION)


# End of the fixed thresholds.
def _contains_any(text: Column, words: list[str]) -> Column:
    cond = None
    for w in words:
        c = text.contains(w)
        cond = c if cond is None else (cond | c)
    return cond


def severity(message: Column) -> Column:
    low = F.lower(message)
    return first_match([(_contains_any(low, kws), tier) for tier, kws in SEVERITY_KEYWORDS],
                       SEVERITY_DEFAULT)


def recovery_route(message: Column) -> Column:
    low = F.lower(message)
    return first_match([(low.contains(k), v) for k, v in RECOVERY_ROUTES],
                       F.lit(None).cast("string"))


def suggestions(error_type: Column) -> Column:
    return first_match([(error_type == k, v) for k, v in ERROR_SUGGESTIONS], DEFAULT_SUGGESTION)
