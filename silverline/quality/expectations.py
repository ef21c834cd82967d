"""Data expectations over one aggregate pass per dataset."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions.text import is_missing
from silverline.operators.joins import side_by_side
from silverline.operators.keyed import expected_extra_rows

# Names of the expectations, default limits, and limits per dataset.
ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
KEY_UNIQUE = "expect_compound_columns_to_be_unique"
ROW_HASH_UNIQUE = "expect_table_row_hash_to_be_unique"
CONTENT_HASH = "expect_content_hash_consistency"
MIN_ROWS, MAX_ROWS = 1, 10_000_000
MAX_NULL_RATE = 0.5
CRITICAL = [ROW_COUNT, CONTENT_HASH]
UNREADABLE = 3


@dataclass(frozen=True)
class Suite:
    """What is expected of one dataset."""

    dataset: str
    columns: tuple[str, ...]
    primary_key: tuple[str, ...]
    null_rate_max: dict[str, float] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    min_rows: int = MIN_ROWS
    max_rows: int = MAX_ROWS
    null_policy: str = "null"


@dataclass(frozen=True)
class Targets:
    """Service levels, and the limits for warning and critical states."""

    completeness: float = 0.99
    freshness_hours: float = 24
    uniqueness: float = 1.0
    availability: float = 0.999
    critical_null_rate: float = 0.9
    critical_duplication: float = 0.5
    critical_staleness_hours: float = 72
    warning_null_rate: float = 0.5
    warning_duplication: float = 0.1
    warning_staleness_hours: float = 24


NULL_RATES: dict[str, dict[str, float]] = {
    "bids": {
        "Contract #": 0.85,
        "Bid Holder List": 0.85,
        "Awarded Vendor(s)": 0.6,
        "Alternate Id": 0.6,
    },
    "contracts": {
        "Bid Solicitation #": 1.0,
        "Type Code": 1.0,
    },
    "purchase_orders": {},
    "vendors": {
        "Address": 1.0,
        "City": 1.0,
        "State": 1.0,
        "Postal Code": 1.0,
    },
}
STRICT_COLUMNS: dict[str, tuple[str, ...]] = {
    "bids": ("Bid Solicitation #", "Organization Name", "Buyer", "Description", "Bid Opening Date", "Status"),
    "contracts": (
        "Contract #", "Description", "Vendor", "Dollars Spent to Date", "Organization", "Status", "Begin Date", "End Date",
    ),
    "purchase_orders": (
        "PO #", "Description", "Vendor", "Organization", "Department", "Buyer", "Status", "Sent Date", "Total",
    ),
    "vendors": ("Vendor ID", "Vendor Name", "Contact Name", "Phone"),
}


def suite_for(dataset: str) -> Suite:
    """The standard suite of a dataset."""
    from silverline.sources.registry import schema_for

    schema = schema_for(dataset)
    return Suite(dataset, schema.columns, (schema.primary_key,), NULL_RATES[dataset], STRICT_COLUMNS[dataset])


def measure(df: DataFrame, suite: Suite, allowances: DataFrame | None = None, count: str = "Duplicate Count") -> DataFrame:
    """Everything the expectations and metrics need, as one row.

    `allowances` says how often records may repeat; what they permit beyond one row each, summed up,
    becomes a column of the row, `expected_duplicates`.

    Counts, bounds and null counts come from one aggregation without a shuffle of rows. Distinct
    counts come from a second, narrow one: a row sends its key and hashes as (kind, value) pairs,
    repeats are dropped in the task, and the pairs carry no other aggregate along.
    """
    nulls = [
        F.count_if(is_missing(F.col(f"`{name}`"), suite.null_policy)).alias(f"null_{i}")
        for i, name in enumerate(suite.columns)
    ]
    plain = df.agg(
        F.count("*").alias("row_count"),
        *nulls,
        F.min("source_file_bytes").alias("bytes_min"),
        F.max("source_file_bytes").alias("bytes_max"),
        F.avg("source_file_bytes").alias("bytes_avg"),
        F.min("ingested_at").alias("first_ingested"),
        F.max("ingested_at").alias("last_ingested"),
    )
    key = [F.col(f"`{name}`").cast("string") for name in suite.primary_key]
    if allowances is not None:
        plain = side_by_side(plain, expected_extra_rows(allowances, count))
    return with_distinct_counts(
        df,
        plain,
        {
            # NULL is a value of a key, but not a value of a single hash or day.
            "unique_keys": (F.to_json(F.struct(*key)) if len(key) > 1 else key[0], True),
            "unique_rows": (F.col("row_hash"), False),
            "source_hashes": (F.col("source_file_hash"), False),
            "ingestion_days": (F.col("ingested_at").cast("date").cast("string"), False),
        },
    )


def with_distinct_counts(df: DataFrame, row: DataFrame, counted: dict[str, tuple[Column, bool]]) -> DataFrame:
    """Add exact distinct counts of several expressions to a one-row table."""
    pairs = F.array(
        *[F.struct(F.lit(i).alias("kind"), value.alias("value")) for i, (value, _) in enumerate(counted.values())]
    )
    distinct = df.select(F.inline(pairs)).distinct()
    counts = distinct.agg(
        *[
            F.count_if((F.col("kind") == i) & (F.lit(nulls) | F.col("value").isNotNull())).alias(name)
            for i, (name, (_, nulls)) in enumerate(counted.items())
        ]
    )
    return side_by_side(row, counts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _result(
    suite: Suite, kind: str, success: str, observed: str, unexpected: str = "null", percent: str = "null",
    checked: str | None = None, **kwargs,
) -> str:
    """One expectation as a SQL struct over the measured row."""
    fields = {
        "dataset": _text(suite.dataset),
        "expectation_type": _text(kind),
        "column": f"cast({_text(checked) if checked else 'null'} as string)",
        "kwargs": _text(json.dumps(kwargs)),
        "observed_value": f"cast({observed} as double)",
        "element_count": "row_count",
        "unexpected_count": f"cast({unexpected} as bigint)",
        "unexpected_percent": f"cast({percent} as double)",
        "success": f"coalesce({success}, false)",
        "critical": str(kind in CRITICAL).lower(),
    }
    return f"named_struct({', '.join(f'{_text(name)}, {value}' for name, value in fields.items())})"


def _rate(part: str) -> str:
    return f"({part} / cast(nullif(row_count, 0) as double))"


def _share(part: Column) -> Column:
    return part.cast("double") / F.nullif(F.col("row_count"), F.lit(0)).cast("double")


def expectations(stats: DataFrame, suite: Suite, expected_duplicates: int = 0) -> DataFrame:
    """One row per expectation. The null rate of an empty table is unknown and fails.

    Rows that repeat a key are expected as far as `stats` has `expected_duplicates`, else as given.
    """
    expected = "expected_duplicates" if "expected_duplicates" in stats.columns else str(int(expected_duplicates))
    bounds = {"min_value": suite.min_rows, "max_value": suite.max_rows}
    within = f"row_count between {suite.min_rows} and {suite.max_rows}"
    results = [_result(suite, ROW_COUNT, within, "row_count", **bounds)]
    for i, name in enumerate(suite.columns):
        limit = suite.null_rate_max.get(name, MAX_NULL_RATE)
        nulls, rate = f"null_{i}", _rate(f"null_{i}")
        results.append(
            _result(
                suite, NOT_NULL, f"{rate} <= {limit}D", f"row_count - {nulls}", nulls, f"{rate} * 100", name,
                column=name, mostly=1 - limit,
            )
        )
    for kind, unique, kwargs in (
        (KEY_UNIQUE, "unique_keys", {"column_list": list(suite.primary_key)}),
        (ROW_HASH_UNIQUE, "unique_rows", {"column": "row_hash"}),
    ):
        off = f"abs(row_count - {unique} - {expected})"
        results.append(_result(suite, kind, f"{off} = 0", unique, off, f"{_rate(off)} * 100", **kwargs))
    results.append(
        _result(suite, CONTENT_HASH, "source_hashes = 1", "source_hashes", expected_unique_hashes=1)
    )
    return stats.selectExpr(f"inline(array({', '.join(results)}))")


def volume_metrics(stats: DataFrame) -> DataFrame:
    return stats.select(
        "row_count",
        "unique_rows",
        (F.col("row_count") - F.col("unique_rows")).alias("duplicate_rows"),
        "bytes_min",
        "bytes_max",
        "bytes_avg",
    )


def freshness_metrics(stats: DataFrame, now: dt.datetime) -> DataFrame:
    return stats.select("first_ingested", "last_ingested", age_hours(now).alias("age_hours"), "ingestion_days")


def age_hours(now: dt.datetime) -> Column:
    at = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.col("last_ingested").cast("timestamp_ntz"), at)
    return seconds / 3600


def has_required_rows(stats: DataFrame, required: int = 1) -> DataFrame:
    """One row: whether a table has the rows it must have."""
    return stats.select("row_count", (F.col("row_count") >= required).alias("valid"))


def severity(results: DataFrame, groups: Sequence[str] = ("dataset",), warning_code: int = 0) -> DataFrame:
    """Status per group: critical failures fail it, any other failure is a warning."""
    failed, critical = ~F.col("success"), F.col("critical")
    rolled = results.groupBy(*groups).agg(
        F.count("*").alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(failed).alias("unsuccessful_expectations"),
        F.count_if(failed & critical).alias("critical_failures"),
    )
    bad, any_bad = F.col("critical_failures") > 0, F.col("unsuccessful_expectations") > 0
    return rolled.withColumns(
        {
            "status": F.when(bad, "failed").when(any_bad, "warning").otherwise("healthy"),
            "exit_code": F.when(bad, 2).when(any_bad, warning_code).otherwise(0),
            "passed": ~bad,
            "has_warnings": F.col("unsuccessful_expectations") > F.col("critical_failures"),
        }
    )


def worst(statuses: DataFrame, unreadable: int = 0) -> DataFrame:
    """One row: the exit code over all datasets; unreadable data outranks any finding."""
    code = F.coalesce(F.max("exit_code"), F.lit(0))
    return statuses.agg((F.lit(UNREADABLE) if unreadable else code).cast("int").alias("exit_code"))


def failed_checks(results: DataFrame) -> DataFrame:
    """Failed expectations in report form."""
    null_check = F.col("expectation_type") == NOT_NULL
    return results.where(~F.col("success")).select(
        "dataset",
        F.replace("expectation_type", F.lit("expect_"), F.lit("")).alias("type"),
        "column",
        F.when(null_check, F.col("unexpected_percent")).alias("null_percent"),
        F.when(null_check, (1 - F.get_json_object("kwargs", "$.mostly").cast("double")) * 100).alias("threshold_percent"),
        F.when(~null_check, F.col("observed_value")).alias("observed"),
        "critical",
    )


def validation_outcome(results: DataFrame, stats: DataFrame, suite: Suite, now: dt.datetime) -> DataFrame:
    """What a manifest records of a validation: status, counters, failures, warnings and metrics.

    A suite has a few dozen expectations, so the lists stay short.
    """
    item = F.struct(F.col("expectation_type").alias("type"), "kwargs", "observed_value", "unexpected_count")
    failed = ~F.col("success")
    lists = results.groupBy("dataset").agg(
        F.sort_array(F.collect_list(F.when(failed & F.col("critical"), item))).alias("failures"),
        F.sort_array(F.collect_list(F.when(failed & ~F.col("critical"), item))).alias("warnings"),
    )
    metrics = stats.select(
        F.lit(suite.dataset).alias("dataset"),
        F.struct(*volume_metrics(stats).columns[:2], "bytes_min", "bytes_max", "bytes_avg").alias("volume"),
        F.struct("first_ingested", "last_ingested", age_hours(now).alias("age_hours"), "ingestion_days").alias("freshness"),
    )
    return severity(results).join(lists, "dataset").join(metrics, "dataset")


def service_levels(stats: DataFrame, suite: Suite, now: dt.datetime, targets: Targets = Targets()) -> DataFrame:
    """Measured service levels against their targets, with a state per measure."""
    strict = [f"null_{i}" for i, name in enumerate(suite.columns) if name in suite.not_null]
    cells = F.col("row_count") * max(len(strict), 1)
    null_rate = sum((F.col(name) for name in strict), F.lit(0)) / F.nullif(cells, F.lit(0))
    duplication = 1 - _share(F.col("unique_keys"))
    age = age_hours(now)

    def measure_row(name: str, value: Column, met: Column, risk: Column, warn: float, crit: float) -> Column:
        state = F.when(risk > crit, "critical").when(risk > warn, "warning").otherwise("ok")
        return F.struct(
            F.lit(suite.dataset).alias("dataset"),
            F.lit(name).alias("measure"),
            value.cast("double").alias("value"),
            F.coalesce(met, F.lit(False)).alias("target_met"),
            state.alias("state"),
        )

    t = targets
    rows = [
        measure_row("completeness", 1 - null_rate, 1 - null_rate >= t.completeness, null_rate, t.warning_null_rate, t.critical_null_rate),
        measure_row("freshness_hours", age, age <= t.freshness_hours, age, t.warning_staleness_hours, t.critical_staleness_hours),
        measure_row("uniqueness", 1 - duplication, 1 - duplication >= t.uniqueness, duplication, t.warning_duplication, t.critical_duplication),
    ]
    return stats.select(F.inline(F.array(*rows)))


def availability(attempts: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """Share of successful runs against the availability target. Needs a `success` column."""
    rate = F.avg(F.col("success").cast("double"))
    return attempts.agg(rate.alias("value"), (rate >= targets.availability).alias("target_met"))


def null_rates(df: DataFrame, columns: Sequence[str], null_policy: str = "null") -> DataFrame:
    """Null count and rate per column: one aggregation over all columns."""
    counts = df.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(is_missing(F.col(f"`{name}`"), null_policy)).alias(f"n{i}") for i, name in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column"), F.col("row_count"), F.col(f"n{i}").alias("null_count"),
            _share(F.col(f"n{i}")).alias("null_rate"),
        )
        for i, name in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the difference; NULLs count as values of a key."""
    grouped = df.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(F.count("*").alias("_n"))
    stats = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_keys")
    )
    return stats.withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_keys"))
