"""Ordered keyword rules, and the expressions that apply them.

A rule table is a list of (label, patterns); the first row with a matching pattern wins. A plain
word matches anywhere in the text; a pattern holding `%` is used as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.numbers import band

Rules = Sequence[tuple[str, Sequence[str]]]

# ---------------------------------------------------------------------------------------------
# Labels, keywords, order and bounds must equal the published classification.
# ---------------------------------------------------------------------------------------------
PO_VENDOR_CASED: Rules = [
    ("Amazon", ["Amazon"]),
    ("Staples", ["Staples"]),
    ("Dell", ["Dell"]),
    ("Grainger", ["Grainger"]),
    ("Office Depot", ["ODP", "Office Depot"]),
]
PO_VENDOR: Rules = [
    ("Amazon", ["amazon"]),
    ("Staples", ["staples"]),
    ("Dell", ["dell"]),
    ("Grainger", ["grainger"]),
    ("CDW", ["cdw"]),
    ("Office Depot", ["office depot", "ODP"]),
    ("Home Depot", ["home depot"]),
]
CONTRACT_VENDOR: Rules = [
    ("Amazon", ["amazon"]),
    ("Staples", ["staples"]),
    ("Dell", ["dell"]),
    ("Grainger", ["grainger"]),
    ("CDW", ["cdw"]),
    ("Office Depot", ["office depot", "ODP"]),
    ("Microsoft", ["microsoft"]),
    ("Oracle", ["oracle"]),
]
VENDOR_BRAND: Rules = [
    ("Amazon", ["amazon"]),
    ("Staples", ["staples"]),
    ("Dell", ["dell"]),
    ("Grainger", ["grainger"]),
    ("CDW", ["cdw"]),
    ("Office Depot", ["office depot", "ODP"]),
    ("Home Depot", ["home depot"]),
    ("Microsoft", ["microsoft"]),
    ("Oracle", ["oracle"]),
    ("Adobe", ["adobe"]),
    ("Cisco", ["cisco"]),
    ("IBM", ["ibm"]),
    ("HP", ["hp ", "hewlett"]),
    ("Xerox", ["xerox"]),
]
VENDOR_TYPE: Rules = [
    ("LLC", ["LLC"]),
    ("Corporation", ["INC"]),
    ("Corporation", ["CORP"]),
    ("Company", ["COMPANY", " CO ", "% CO."]),
    ("Partnership", ["PARTNERSHIP"]),
    ("Foundation", ["FOUNDATION"]),
    ("Educational", ["UNIVERSITY", "COLLEGE"]),
    ("Government", ["GOVERNMENT", "STATE OF", "CITY OF"]),
    ("DBA", ["DBA"]),
]
VENDOR_INDUSTRY: Rules = [
    ("Technology", ["software", "technology", "computer"]),
    ("Healthcare", ["medical", "health", "pharma"]),
    ("Construction", ["construction", "building", "contractor"]),
    ("Consulting", ["consulting", "advisory"]),
    ("Transportation", ["transport", "logistics", "freight"]),
    ("Energy", ["electric", "energy", "power"]),
    ("Food Service", ["food", "catering", "restaurant"]),
    ("Office Supplies", ["office", "supplies", "stationery"]),
]
PO_STATUS_CLASS: Rules = [
    ("Closed", ["Closed", "3PCO"]),
    ("Complete", ["Complete", "3PCR"]),
    ("Cancelled", ["Cancelled", "3PCA"]),
    ("Sent", ["Sent", "3PS"]),
    ("Partial", ["Partial", "3PPR"]),
    ("Draft", ["Draft", "1D"]),
    ("Hold", ["Hold", "3PPOH"]),
]
PO_STATUS_NAMES_FULL = {
    "3PS - Sent": "Sent",
    "3PCR - Complete Receipt": "Complete",
    "3PCO - Closed": "Closed",
    "3PPR - Partial Receipt": "Partial Receipt",
    "3PD - Draft": "Draft",
    "3PC - Cancelled": "Cancelled",
}
PO_STATUS_NAMES = {
    "3PS - Sent": "Sent",
    "3PCR - Complete Receipt": "Complete Receipt",
    "3PCO - Closed": "Closed",
    "3PPR - Partial Receipt": "Partial Receipt",
}
PO_STATUS_GROUPS_FULL = {
    "Complete": ["3PCO - Closed", "3PCR - Complete Receipt"],
    "Active": ["3PS - Sent", "3PPR - Partial Receipt"],
    "Pending": ["3PD - Draft"],
    "Cancelled": ["3PC - Cancelled"],
}
PO_STATUS_GROUPS = {
    "Complete": ["3PCO - Closed", "3PCR - Complete Receipt"],
    "Active": ["3PS - Sent", "3PPR - Partial Receipt"],
}
BID_STATUS_NAMES = {
    "Approved": "Approved",
    "Bid to PO": "Converted to PO",
    "Closed": "Closed",
    "Evaluated": "Under Evaluation",
    "Opened": "Open for Bidding",
    "Sent": "Sent to Vendors",
}
BID_STATUS_GROUPS = {
    "Complete": ["Approved", "Bid to PO", "Closed"],
    "In Progress": ["Evaluated"],
    "Active": ["Opened", "Sent"],
}
AMOUNT_BANDS = [
    (1_000, "Micro (<$1K)"),
    (10_000, "Small ($1K-$10K)"),
    (100_000, "Medium ($10K-$100K)"),
    (1_000_000, "Large ($100K-$1M)"),
]
AMOUNT_ZERO = "Zero"
AMOUNT_TOP = "Mega (>$1M)"
STATEWIDE = "Statewide Contracts"
FIRST_DAY_OF_DATA = "2018-01-31"
# ---------------------------------------------------------------------------------------------


def contains_any(value: Column, patterns: Sequence[str], ignore_case: bool = True) -> Column:
    """Whether any pattern matches; NULL text gives NULL."""

    def one(pattern: str) -> Column:
        like = pattern if "%" in pattern else f"%{pattern}%"
        return value.ilike(like) if ignore_case else value.like(like)

    return reduce(lambda left, right: left | right, [one(pattern) for pattern in patterns])


def first_match(value: Column, rules: Rules, default: str = "Other", ignore_case: bool = True) -> Column:
    label, patterns = rules[0]
    out = F.when(contains_any(value, patterns, ignore_case), label)
    for label, patterns in rules[1:]:
        out = out.when(contains_any(value, patterns, ignore_case), label)
    return out.otherwise(default)


def decode(value: Column, names: dict[str, str], otherwise: Column) -> Column:
    """Exact lookup of short code lists."""
    out = None
    for code, name in names.items():
        out = F.when(value == code, name) if out is None else out.when(value == code, name)
    return out.otherwise(otherwise)


def group_of(value: Column, groups: dict[str, list[str]], default: str = "Unknown") -> Column:
    out = None
    for name, members in groups.items():
        hit = value.isin(members)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def three_way(value: Column, true_values: Sequence[str], false_values: Sequence[str]) -> Column:
    """TRUE, FALSE, or NULL when the value is in neither list."""
    return F.when(value.isin(list(true_values)), True).when(value.isin(list(false_values)), False)


def phone_type(phone: Column, phone_digits: Column) -> Column:
    """Class of a phone number by its digits."""
    size = F.length(phone_digits)
    return (
        F.when(size == 10, "Standard")
        .when((size == 11) & phone_digits.startswith("1"), "Standard with 1")
        .when((size > 10) & phone.ilike("%ext%"), "With Extension")
        .when(size < 10, "Incomplete")
        .otherwise("Non-standard")
    )


def amount_band(amount: Column, strict: bool = False) -> Column:
    """Six amount bands. An unknown amount falls into the top band unless `strict`."""
    out = band(amount, AMOUNT_BANDS, AMOUNT_ZERO, AMOUNT_TOP)
    return F.when(amount >= 0, out) if strict else out
