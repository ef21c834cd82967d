"""Silver vendors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions import rules, text
from silverline.plans.silver.common import (
    SilverRun,
    Transform,
    free_of,
    lineage,
    newest_version,
    raw,
    silver_stamp,
)

KEY = "Vendor ID"
# Spellings of the home state.
HOME_STATE = ["NV", "Nevada"]


def v010(bronze: DataFrame, run: SilverRun) -> DataFrame:
    """Digits are extracted by dropping the first other character only, as this version defines it."""
    out = bronze.select(
        raw(KEY).alias("vendor_id"),
        raw("Vendor Name").alias("vendor_name"),
        raw("Address").alias("address"),
        raw("City").alias("city"),
        raw("State").alias("state"),
        raw("Postal Code").alias("postal_code"),
        raw("Contact Name").alias("contact_name"),
        raw("Phone").alias("phone"),
        F.coalesce(raw("State").isin(HOME_STATE), F.lit(False)).alias("is_nevada_vendor"),
        text.drop_first_non_digit(raw("Phone")).alias("phone_digits_only"),
        F.substring(text.drop_first_non_digit(raw("Postal Code")), 1, 5).alias("zip5"),
        *[raw(name) for name in ("source_system", "source_file", "source_file_hash", "source_row", "ingested_at", "bronze_run_id")],
        raw("row_hash").alias("bronze_row_hash"),
        *silver_stamp("v0.1.0", run, "vendors"),
    )
    return out.where(
        (F.col("vendor_id") != "")
        & (F.col("vendor_name") != "")
        & free_of(F.col("vendor_name"), ["TEST", "DEMO", "DO NOT USE"], ignore_case=False)
    )


def _typed(bronze: DataFrame, run: SilverRun, version: str) -> DataFrame:
    rows = newest_version(bronze, KEY).withColumn("phone_digits", text.digits(raw("Phone")))
    name, digits = raw("Vendor Name"), F.col("phone_digits")
    no_address = raw("Address").isNull() & raw("City").isNull() & raw("State").isNull()
    return rows.select(
        raw(KEY).alias("vendor_id"),
        name.alias("vendor_name"),
        text.match_name(name).alias("vendor_name_clean"),
        raw("Address").alias("address"),
        raw("City").alias("city"),
        raw("State").alias("state"),
        raw("Postal Code").alias("postal_code"),
        raw("Contact Name").alias("contact_name"),
        raw("Phone").alias("phone"),
        digits,
        rules.phone_type(raw("Phone"), digits).alias("phone_type"),
        rules.first_match(name, rules.VENDOR_TYPE).alias("vendor_type"),
        rules.first_match(name, rules.VENDOR_BRAND).alias("vendor_category"),
        rules.first_match(name, rules.VENDOR_INDUSTRY).alias("industry_category"),
        no_address.alias("is_missing_address"),
        (F.length(digits) != 10).alias("is_non_standard_phone"),
        *lineage(version, run),
    )


def v020(bronze: DataFrame, run: SilverRun) -> DataFrame:
    return _typed(bronze, run, "v0.2.0").where(
        F.col("vendor_id").isNotNull()
        & (F.length(F.trim("vendor_name")) > 0)
        & free_of(F.col("vendor_name"), ["TEST", "DEMO", "DO NOT USE"], ignore_case=True)
        & free_of(F.col("vendor_id"), ["TEST"], ignore_case=True)
    )


def v030(bronze: DataFrame, run: SilverRun) -> DataFrame:
    return _typed(bronze.where(raw(KEY).isNotNull()), run, "v0.3.0")


_ORDER = (("vendor_name", "asc"),)
TRANSFORMS = [
    Transform("vendors", "v0.1.0", v010, "vendor_id"),
    Transform("vendors", "v0.2.0", v020, "vendor_id", _ORDER),
    Transform("vendors", "v0.3.0", v030, "vendor_id", _ORDER),
]
