"""Silver purchase orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions import dates, numbers, rules, text
from silverline.operators.joins import star_join
from silverline.operators.keyed import with_instances
from silverline.operators.positions import dimensions
from silverline.plans.silver.common import (
    BRONZE_METADATA,
    SilverRun,
    Transform,
    free_of,
    lineage,
    newest_version,
    raw,
    silver_stamp,
)
from silverline.session import ensure_checkpointing

KEY = "PO #"


def _parsed(bronze: DataFrame, precision: int) -> DataFrame:
    """Parse the date and the amount once; everything else is derived from these."""
    return bronze.withColumns(
        {
            "_day": dates.parse_date(raw("Sent Date")),
            "_amount": numbers.money(raw("Total"), precision),
        }
    )


def _short(value: Column) -> Column:
    return value.cast("smallint")


def _tiny(value: Column) -> Column:
    return value.cast("tinyint")


def _revision(kind: str, separators: str) -> Column:
    return numbers.whole_number(text.revision_text(raw(KEY), separators), kind).alias("revision_number")


def _status_name(names: dict[str, str]) -> Column:
    return rules.decode(raw("Status"), names, F.split_part(raw("Status"), F.lit(" - "), F.lit(2)))


def _seen() -> list[Column]:
    return [raw("ingested_at").alias("first_seen_at"), raw("ingested_at").alias("last_seen_at")]


def _never_null(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def v010(bronze: DataFrame, run: SilverRun) -> DataFrame:
    rows = _parsed(newest_version(bronze, KEY), 18)
    day, amount = F.col("_day"), F.col("_amount")
    out = rows.select(
        F.trim(raw(KEY)).alias("po_id"),
        _revision("int", ":"),
        text.base_id(raw(KEY), ":").alias("base_po_id"),
        raw("Sent Date").alias("sent_date_raw"),
        day.alias("sent_date"),
        raw("Status").alias("status_code"),
        _status_name(rules.PO_STATUS_NAMES_FULL).alias("status"),
        rules.group_of(raw("Status"), rules.PO_STATUS_GROUPS_FULL).alias("status_category"),
        *[F.trim(raw(name)).alias(name.lower()) for name in ("Description", "Vendor", "Organization", "Department", "Buyer")],
        raw("Total").alias("total_raw"),
        amount.alias("total_amount"),
        dates.fiscal_year(day).alias("fiscal_year"),
        F.quarter(day).alias("calendar_quarter"),
        dates.fiscal_quarter(day).alias("fiscal_quarter"),
        F.year(day).alias("sent_year"),
        F.month(day).alias("sent_month"),
        _never_null((amount == 0) | (raw("Total") == "$.00")).alias("is_zero_dollar"),
        _never_null(raw("Organization") == rules.STATEWIDE).alias("is_statewide_contract"),
        *_seen(),
        F.lit(1).alias("version_count"),
        raw("source_system"),
        raw("source_file"),
        raw("source_file_hash"),
        raw("row_hash").alias("bronze_row_hash"),
        *silver_stamp("v0.1.0", run),
    )
    return out.where(
        (F.col("po_id") != "")
        & F.col("sent_date").between(F.lit(rules.FIRST_DAY_OF_DATA).cast("date"), dates.shifted(run.today, 30))
        & (F.col("total_amount").isNull() | (F.col("total_amount") >= 0))
        & free_of(F.col("po_id"), ["TEST", "DEMO", "TEMP"], ignore_case=False)
    )


def v020_optimized(bronze: DataFrame, run: SilverRun, null_safe: bool = False) -> DataFrame:
    """Star schema: organization, department and status become dimensions with surrogate ids.

    Rows and dimensions both come from the deduplicated records, which are stored once for them.
    """
    ensure_checkpointing(bronze.sparkSession)
    newest = newest_version(bronze, KEY).checkpoint()
    keyed = {
        "Organization": "organization_id",
        "Department": "department_id",
        "Status": "status_id",
    }
    rows = star_join(_parsed(newest, 12), dimensions(newest, keyed), null_safe)
    day = F.col("_day")
    amount = F.coalesce(F.col("_amount"), F.lit(0).cast("decimal(12,2)"))
    out = rows.select(
        F.trim(raw(KEY)).alias("po_id"),
        text.base_id(raw(KEY), ":.").alias("base_po_id"),
        _revision("smallint", ":."),
        day.alias("sent_date"),
        amount.alias("total_amount"),
        F.trim(raw("Description")).alias("description"),
        F.trim(raw("Vendor")).alias("vendor_name"),
        F.trim(raw("Buyer")).alias("buyer_name"),
        *[F.col(key) for key in keyed.values()],
        raw("Organization").alias("organization"),
        raw("Department").alias("department"),
        _status_name(rules.PO_STATUS_NAMES).alias("status"),
        rules.group_of(raw("Status"), rules.PO_STATUS_GROUPS).alias("status_category"),
        *_calendar(day),
        _never_null(F.col("_amount") == 0).alias("is_zero_dollar"),
        _never_null(raw("Organization") == rules.STATEWIDE).alias("is_statewide_contract"),
        _never_null(raw("Description").like("G2B%")).alias("is_g2b_purchase"),
        rules.first_match(raw("Vendor"), rules.PO_VENDOR_CASED, ignore_case=False).alias("vendor_category"),
        *[column.cast("timestamp_ntz").alias(name) for column, name in zip(_seen(), ("first_seen_at", "last_seen_at"))],
        F.lit(1).cast("smallint").alias("version_count"),
        raw("source_file_hash").alias("source_hash"),
        raw("row_hash"),
        *silver_stamp("v0.2.0", run),
    )
    return out.where(
        F.col("po_id").isNotNull()
        & _in_period(F.col("sent_date"), run)
        & (F.col("total_amount") >= 0)
        & free_of(F.col("po_id"), ["TEST", "DEMO", "TEMP", "SAMPLE"], ignore_case=False)
        & free_of(F.col("vendor_name"), ["TEST", "DEMO", "DO NOT USE"], ignore_case=False)
    )


def _in_period(day: Column, run: SilverRun) -> Column:
    return day.between(F.lit(rules.FIRST_DAY_OF_DATA).cast("date"), dates.shifted(run.today, 30))


def _calendar(day: Column) -> list[Column]:
    return [
        _short(dates.fiscal_year(day)).alias("fiscal_year"),
        _tiny(dates.fiscal_quarter(day)).alias("fiscal_quarter"),
        _short(F.year(day)).alias("calendar_year"),
        _tiny(F.month(day)).alias("calendar_month"),
        _tiny(F.quarter(day)).alias("calendar_quarter"),
    ]


def _typed(bronze: DataFrame, run: SilverRun, version: str) -> DataFrame:
    """The columns of v0.3.0 and v0.4.0."""
    rows = _parsed(newest_version(bronze, KEY), 15)
    day, amount = F.col("_day"), F.col("_amount")
    return rows.select(
        raw(KEY).alias("po_id"),
        text.base_id(raw(KEY), ":.").alias("base_po_id"),
        _revision("smallint", ":."),
        day.alias("sent_date"),
        amount.alias("total_amount"),
        raw("Description").alias("description"),
        raw("Vendor").alias("vendor_name"),
        raw("Organization").alias("organization"),
        raw("Department").alias("department"),
        raw("Buyer").alias("buyer_name"),
        raw("Status").alias("status_code"),
        _status_name(rules.PO_STATUS_NAMES).alias("status_name"),
        rules.group_of(raw("Status"), rules.PO_STATUS_GROUPS).alias("status_category"),
        *_calendar(day),
        (amount == 0).alias("is_zero_dollar"),
        (raw("Organization") == rules.STATEWIDE).alias("is_statewide_contract"),
        raw("Description").like("G2B%").alias("is_g2b_purchase"),
        rules.first_match(raw("Vendor"), rules.PO_VENDOR).alias("vendor_category"),
        rules.amount_band(amount).alias("amount_category"),
        *lineage(version, run),
    )


def v030(bronze: DataFrame, run: SilverRun) -> DataFrame:
    return _typed(bronze, run, "v0.3.0").where(
        F.col("po_id").isNotNull()
        & _in_period(F.col("sent_date"), run)
        & (F.col("total_amount") >= 0)
        & free_of(F.col("po_id"), ["TEST", "DEMO"], ignore_case=True)
        & free_of(F.col("vendor_name"), ["TEST", "DO NOT USE"], ignore_case=True)
    )


def v040(bronze: DataFrame, run: SilverRun) -> DataFrame:
    # Rows without a key form one group of their own; they are dropped before the shuffle.
    return _typed(bronze.where(raw(KEY).isNotNull()), run, "v0.4.0")


def v050(bronze: DataFrame, run: SilverRun) -> DataFrame:
    """No deduplication: repeated records are numbered instead, by `source_row`; the file and the row hash only settle ties."""
    ties = ["source_row", "source_file_hash", "row_hash"]
    numbered = with_instances(bronze, [KEY], [F.col(name).asc_nulls_last() for name in ties], F.col("source_row"))
    rows = _parsed(numbered, 15)
    day, amount = F.col("_day"), F.col("_amount")
    key = raw(KEY)
    after_marker = F.substring(F.split_part(key, F.lit("-NV"), F.lit(2)), 1, 2)
    return rows.select(
        key.alias("po_id"),
        text.base_id(key, ":.").alias("base_po_id"),
        _revision("smallint", ":."),
        day.alias("sent_date"),
        amount.alias("total_amount"),
        raw("Description").alias("description"),
        raw("Vendor").alias("vendor_name"),
        raw("Organization").alias("organization"),
        raw("Department").alias("department"),
        raw("Buyer").alias("buyer_name"),
        raw("Status").alias("status"),
        # In this version the three fiscal columns hold calendar parts.
        _short(F.year(day)).alias("fiscal_year"),
        _tiny(F.quarter(day)).alias("fiscal_quarter"),
        _tiny(F.month(day)).alias("fiscal_month"),
        F.when(F.contains(key, F.lit("-")), F.split_part(key, F.lit("-"), F.lit(1))).alias("org_code"),
        F.when(
            F.contains(key, F.lit("-NV")), numbers.whole_number(F.concat(F.lit("20"), after_marker))
        ).alias("po_fiscal_year"),
        rules.first_match(raw("Status"), rules.PO_STATUS_CLASS, ignore_case=False).alias("status_category"),
        amount.isNotNull().alias("has_valid_amount"),
        day.isNotNull().alias("has_valid_date"),
        F.col("instance_number"),
        F.col("total_instances"),
        *[F.col(name) for name in BRONZE_METADATA],
        run.now.alias("silver_processed_at"),
        F.lit("v0.5.0").alias("silver_version"),
    )


_ORDER = (("sent_date", "desc"), ("po_id", "asc"))
TRANSFORMS = [
    Transform("purchase_orders", "v0.1.0", v010, "po_id"),
    Transform("purchase_orders", "v0.2.0", v020_optimized, "po_id", _ORDER, variant="optimized"),
    Transform("purchase_orders", "v0.3.0", v030, "po_id", _ORDER),
    Transform("purchase_orders", "v0.4.0", v040, "po_id", _ORDER),
    Transform("purchase_orders", "v0.5.0", v050, "po_id"),
]
