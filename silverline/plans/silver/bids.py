"""Silver bids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions import dates, rules, text
from silverline.functions.links import HOLDER_LIST_PATH
from silverline.plans.silver.common import (
    SilverRun,
    Transform,
    free_of,
    lineage,
    newest_version,
    raw,
    silver_stamp,
)

KEY = "Bid Solicitation #"
# Award states.
AWARDED = ["Awarded"]
NOT_AWARDED = ["Sent", "Open"]


def v010(bronze: DataFrame, run: SilverRun) -> DataFrame:
    """Raw and cleaned values side by side; no deduplication."""
    listed = raw("Bid Holder List") == HOLDER_LIST_PATH
    link = F.concat(F.lit(f"https://{run.portal_host}{HOLDER_LIST_PATH}?bidId="), raw(KEY))
    out = bronze.select(
        raw(KEY).alias("bid_id"),
        raw("Organization Name").alias("organization"),
        raw("Buyer").alias("buyer"),
        raw("Description").alias("description"),
        raw("Status").alias("status"),
        raw("Contract #").alias("contract_id_raw"),
        text.blank_to_null(raw("Contract #")).alias("contract_id"),
        raw("Bid Opening Date").alias("bid_opening_date_raw"),
        dates.parse_timestamp(raw("Bid Opening Date")).alias("bid_opening_date"),
        raw("Bid Holder List").alias("bid_holder_list_raw"),
        listed.alias("has_holder_list"),
        F.when(listed, link).alias("bid_holder_list_url"),
        F.when(listed, run.portal_host).alias("bid_holder_list_url_host"),
        F.when(listed, HOLDER_LIST_PATH).alias("bid_holder_list_url_path"),
        raw("Awarded Vendor(s)").alias("awarded_vendors_raw"),
        text.blank_to_null(raw("Awarded Vendor(s)")).alias("awarded_vendors"),
        raw("Alternate Id").alias("alternate_id_raw"),
        text.blank_to_null(raw("Alternate Id")).alias("alternate_id"),
        rules.three_way(raw("Status"), AWARDED, NOT_AWARDED).alias("is_awarded"),
        raw("source_system"),
        raw("source_file"),
        raw("source_row"),
        raw("ingested_at"),
        raw("row_hash").alias("bronze_row_hash"),
        *silver_stamp("v0.1.0", run, "bids"),
    )
    opening = F.col("bid_opening_date")
    in_range = opening.between(
        F.lit(rules.FIRST_DAY_OF_DATA).cast("timestamp_ntz"), dates.shifted(run.today, 365).cast("timestamp_ntz")
    )
    return out.where((F.col("bid_id") != "") & (opening.isNull() | in_range))


def _typed(bronze: DataFrame, run: SilverRun, version: str) -> DataFrame:
    rows = newest_version(bronze, KEY).withColumn("_opening", dates.parse_timestamp(raw("Bid Opening Date")))
    opening = F.col("_opening")
    status = raw("Status")
    group = rules.group_of(status, rules.BID_STATUS_GROUPS)
    vendors = raw("Awarded Vendor(s)")
    return rows.select(
        raw(KEY).alias("bid_solicitation_id"),
        raw("Contract #").alias("contract_id"),
        raw("Alternate Id").alias("alternate_id"),
        raw("Description").alias("description"),
        raw("Organization Name").alias("organization"),
        raw("Buyer").alias("buyer_name"),
        opening.alias("bid_opening_timestamp"),
        opening.cast("date").alias("bid_opening_date"),
        F.hour(opening).cast("tinyint").alias("bid_opening_hour"),
        F.minute(opening).cast("tinyint").alias("bid_opening_minute"),
        dates.day_index(opening).cast("tinyint").alias("bid_opening_dow"),
        dates.day_name(opening).alias("bid_opening_day_name"),
        dates.in_business_hours(opening).alias("is_business_hours"),
        status.alias("status_code"),
        rules.decode(status, rules.BID_STATUS_NAMES, status).alias("status_name"),
        group.alias("status_category"),
        raw("Bid Holder List").alias("bid_holder_list"),
        raw("Bid Holder List").isNotNull().alias("has_bid_holder_list"),
        vendors.alias("awarded_vendors"),
        text.has_text(vendors).alias("has_awarded_vendor"),
        text.part_count(vendors).alias("awarded_vendor_count"),
        F.when(opening > run.now, "Future").otherwise(group).alias("bid_status"),
        dates.days_between(opening, run.today).alias("days_since_opening"),
        dates.fiscal_year(opening).cast("smallint").alias("fiscal_year"),
        dates.fiscal_quarter(opening).cast("tinyint").alias("fiscal_quarter"),
        text.has_text(raw("Contract #")).alias("has_contract"),
        (raw("Organization Name") == rules.STATEWIDE).alias("is_statewide"),
        (status == "Bid to PO").alias("is_converted_to_po"),
        *lineage(version, run),
    )


def v020(bronze: DataFrame, run: SilverRun) -> DataFrame:
    opening = F.col("bid_opening_timestamp")
    return _typed(bronze, run, "v0.2.0").where(
        F.col("bid_solicitation_id").isNotNull()
        & (opening >= F.lit(rules.FIRST_DAY_OF_DATA).cast("timestamp_ntz"))
        & (opening <= run.now + F.expr("interval 365 day"))
        & free_of(F.col("bid_solicitation_id"), ["TEST"], ignore_case=True)
        & free_of(F.col("description"), ["TEST", "DEMO"], ignore_case=True)
    )


def v030(bronze: DataFrame, run: SilverRun) -> DataFrame:
    return _typed(bronze.where(raw(KEY).isNotNull()), run, "v0.3.0")


_ORDER = (("bid_opening_timestamp", "desc"), ("bid_solicitation_id", "asc"))
TRANSFORMS = [
    Transform("bids", "v0.1.0", v010, "bid_id"),
    Transform("bids", "v0.2.0", v020, "bid_solicitation_id", _ORDER),
    Transform("bids", "v0.3.0", v030, "bid_solicitation_id", _ORDER),
]
