"""Silver contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.functions import dates, numbers, rules
from silverline.plans.silver.common import (
    SilverRun,
    Transform,
    free_of,
    lineage,
    newest_version,
    raw,
    silver_stamp,
)

KEY = "Contract #"
SPENT = "Dollars Spent to Date"
# States that count as active and as ended, and the date limits of the filters.
ACTIVE = ["Active", "Current", "Open"]
ENDED = ["Expired", "Terminated", "Cancelled", "Closed"]
EARLIEST_KNOWN = "2000-01-01"
LATEST_END = "2050-12-31"


def v010(bronze: DataFrame, run: SilverRun) -> DataFrame:
    """Raw and cleaned values side by side; no deduplication."""
    begin, end = F.col("begin_date"), F.col("end_date")
    rows = bronze.withColumns(
        {"begin_date": dates.parse_date(raw("Begin Date")), "end_date": dates.parse_date(raw("End Date"))}
    )
    out = rows.select(
        raw(KEY).alias("contract_id"),
        raw("Bid Solicitation #").alias("bid_solicitation_id"),
        raw("Description").alias("description"),
        raw("Vendor").alias("vendor"),
        raw("Type Code").alias("type_code"),
        raw("Organization").alias("organization"),
        raw("Status").alias("status"),
        raw(SPENT).alias("dollars_spent_raw"),
        numbers.money(raw(SPENT), 18).alias("dollars_spent"),
        raw("Begin Date").alias("begin_date_raw"),
        begin,
        raw("End Date").alias("end_date_raw"),
        end,
        rules.three_way(raw("Status"), ACTIVE, ENDED).alias("is_active"),
        dates.days_between(begin, end).alias("contract_duration_days"),
        *[raw(name) for name in ("source_system", "source_file", "source_file_hash", "source_row", "ingested_at", "bronze_run_id")],
        raw("row_hash").alias("bronze_row_hash"),
        *silver_stamp("v0.1.0", run, "contracts"),
    )
    earliest = F.lit(EARLIEST_KNOWN).cast("date")
    spent = F.col("dollars_spent")
    return out.where(
        (F.col("contract_id") != "")
        & (begin.isNull() | begin.between(earliest, dates.shifted(run.today, 365)))
        & (end.isNull() | (end >= earliest))
        & (spent.isNull() | (spent >= 0))
        & free_of(F.col("contract_id"), ["TEST", "DEMO"], ignore_case=False)
    )


def _typed(bronze: DataFrame, run: SilverRun, version: str) -> DataFrame:
    rows = newest_version(bronze, KEY).withColumns(
        {
            "_begin": dates.parse_date(raw("Begin Date")),
            "_end": dates.parse_date(raw("End Date")),
            "_spent": numbers.money(raw(SPENT), 12),
        }
    )
    begin, end, spent = F.col("_begin"), F.col("_end"), F.col("_spent")
    days_so_far = dates.days_between(begin, F.least(run.today, end))
    rate = numbers.rounded_ratio(spent, days_so_far)
    state = F.when(run.today < begin, "Future").when(run.today > end, "Expired").otherwise("Active")
    status = raw("Status")
    return rows.select(
        raw(KEY).alias("contract_id"),
        raw("Bid Solicitation #").alias("bid_solicitation_id"),
        raw("Type Code").alias("type_code"),
        raw("Description").alias("description"),
        raw("Vendor").alias("vendor_name"),
        raw("Organization").alias("organization"),
        spent.alias("dollars_spent_to_date"),
        begin.alias("begin_date"),
        end.alias("end_date"),
        dates.days_between(begin, end).alias("contract_duration_days"),
        dates.month_boundaries(begin, end).alias("contract_duration_months"),
        status.alias("status_code"),
        F.when(status == "3PS - Sent", "Sent")
        .otherwise(F.split_part(status, F.lit(" - "), F.lit(2)))
        .alias("status_name"),
        state.alias("contract_status"),
        dates.days_between(run.today, end).alias("days_until_expiration"),
        dates.fiscal_year(begin).cast("smallint").alias("fiscal_year_begin"),
        dates.fiscal_year(end).cast("smallint").alias("fiscal_year_end"),
        (spent == 0).alias("is_zero_spend"),
        (raw("Organization") == rules.STATEWIDE).alias("is_statewide_contract"),
        (dates.year_boundaries(begin, end) > 1).alias("is_multi_year"),
        F.when(run.today > begin, rate).alias("daily_spend_rate"),
        rules.first_match(raw("Vendor"), rules.CONTRACT_VENDOR).alias("vendor_category"),
        *lineage(version, run),
    )


def v020(bronze: DataFrame, run: SilverRun) -> DataFrame:
    begin, end = F.col("begin_date"), F.col("end_date")
    return _typed(bronze, run, "v0.2.0").where(
        F.col("contract_id").isNotNull()
        & (begin <= end)
        & (begin >= F.lit(rules.FIRST_DAY_OF_DATA).cast("date"))
        & (end <= F.lit(LATEST_END).cast("date"))
        & (F.col("dollars_spent_to_date") >= 0)
        & free_of(F.col("contract_id"), ["TEST"], ignore_case=True)
        & free_of(F.col("vendor_name"), ["TEST", "DO NOT USE"], ignore_case=True)
    )


def v030(bronze: DataFrame, run: SilverRun) -> DataFrame:
    return _typed(bronze.where(raw(KEY).isNotNull()), run, "v0.3.0")


_ORDER = (("begin_date", "desc"), ("contract_id", "asc"))
TRANSFORMS = [
    Transform("contracts", "v0.1.0", v010, "contract_id"),
    Transform("contracts", "v0.2.0", v020, "contract_id", _ORDER),
    Transform("contracts", "v0.3.0", v030, "contract_id", _ORDER),
]
