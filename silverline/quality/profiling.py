"""Column profiles and type recommendations.

All columns are profiled together, and no value leaves the task that read it but for those of a list:
lengths, amounts and counts are combined sums of the rows; distinct values are counted by 128 bits of
hash, which repeats within a task share; the values of a column that has few of them come from an
aggregate of bounded size, which gives up on columns with many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions.dates import parse_date, parse_timestamp
from silverline.functions.numbers import money
from silverline.plans.silver.common import BRONZE_METADATA

# Domain sizes, and the widths of the text bands.
STATUS_DOMAIN = 20
SMALL_DOMAIN = 10
LOW_CARDINALITY, LOW_CARDINALITY_ROWS = 50, 100
MAX_CHECK_LENGTH = 500
TEXT_BANDS = [(32, 8), (64, 16), (128, 32)]
EMPTY_WIDTHS = [
    ("Address", "VARCHAR(100)"),
    ("City", "VARCHAR(50)"),
    ("State", "VARCHAR(2)"),
    ("Postal", "VARCHAR(10)"),
    ("Zip", "VARCHAR(10)"),
]
MONEY_WORDS = ["Dollar", "Amount", "Cost"]
MONEY_BANDS = [(10_000, 8), (1_000_000, 10), (100_000_000, 12), (10_000_000_000, 15)]
INTEGER_BANDS = [
    (0, 2**8, "UTINYINT"),
    (-(2**7), 2**7, "TINYINT"),
    (0, 2**16, "USMALLINT"),
    (-(2**15), 2**15, "SMALLINT"),
    (0, 2**32, "UINTEGER"),
    (-(2**31), 2**31, "INTEGER"),
]


def business_columns(df: DataFrame) -> list[str]:
    """Columns without bronze metadata and partition columns."""
    skip = {*BRONZE_METADATA, "ingest_date", "sha256"}
    return [name for name in df.columns if name not in skip and not name.startswith("row_hash_")]


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(ordinal, value) of every row and column."""
    cells = [F.struct(F.lit(i).alias("ordinal"), F.col(f"`{name}`").cast("string").alias("value")) for i, name in enumerate(columns)]
    return df.select(F.inline(F.array(*cells)))


def _named(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The statistics with the name of each column."""
    return stats.withColumn("column", F.get(F.array(*[F.lit(name) for name in columns]), F.col("ordinal")))


def _distinct_counts(cells: DataFrame, **kinds: Column) -> DataFrame:
    """Distinct values of each kind, one row per ordinal: narrow rows of hashes, not values, are shuffled."""
    hashed = cells.where(F.col("value").isNotNull()).select(
        "ordinal", F.xxhash64("value").alias("h1"), F.xxhash64(F.lit("second"), "value").alias("h2"),
        *[F.coalesce(kind, F.lit(False)).alias(name) for name, kind in kinds.items()],
    )
    counts = hashed.distinct().groupBy("ordinal").agg(*[F.count_if(F.col(name)).alias(name) for name in kinds])
    return counts.withColumnRenamed("ordinal", "_at")


def _few_values(value: Column, most: int) -> Column:
    """The distinct values, sorted, if there are `most` at most; what comes back for more is not to be used.

    The sketch behind it is exact as long as it has room for every value, and of one size with any number.
    """
    found = F.call_function("approx_top_k", value, F.lit(most + 1), F.lit(max(64, 4 * most)))
    return F.array_sort(F.filter(F.transform(found, lambda x: x["item"]), lambda x: x.isNotNull()))


def _smallest(df: DataFrame, columns: Sequence[str], k: int) -> list[list[str]]:
    """The k smallest present values of each column: k passes of combined minima, each beyond the last."""
    found: list[list[str]] = [[] for _ in columns]
    for _ in range(k):
        minima = []
        for i, name in enumerate(columns):
            value = F.col(f"`{name}`").cast("string")
            beyond = value > found[i][-1] if found[i] else F.lit(True)
            minima.append(F.min(F.when((F.trim(value) != "") & beyond, value)).alias(f"m{i}"))
        row = df.agg(*minima).first()
        for i, value in enumerate(row):
            if value is not None:
                found[i].append(value)
    return found


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, samples: int = 3) -> DataFrame:
    """Per column: missing values (NULL or blank) and their share, distinct values, samples."""
    names = list(columns or df.columns)
    cells = _cells(df, names)
    present = F.coalesce(F.trim("value") != "", F.lit(False))
    stats = cells.groupBy("ordinal").agg(F.count("*").alias("total_rows"), F.count_if(~present).alias("null_count"))
    distinct = _distinct_counts(cells, unique_values=present)
    lists = F.array(*[F.array(*[F.lit(v) for v in few]).cast("array<string>") for few in _smallest(df, names, samples)])
    joined = _named(stats.join(distinct, F.col("ordinal") == F.col("_at"), "left"), names)
    return joined.select(
        "ordinal",
        "column",
        "total_rows",
        "null_count",
        (F.col("null_count") * 100.0 / F.col("total_rows")).cast("double").alias("null_percent"),
        F.coalesce("unique_values", F.lit(0)).cast("long").alias("unique_values"),
        F.get(lists, F.col("ordinal")).alias("sample_values"),
    )


def _measured(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The numbers the type rules look at, and the domain of columns with few values, one row per column."""
    cells = _cells(df, columns)
    value = F.col("value")
    filled = value.isNotNull() & (value != "")
    amount = money(value, 38, 4)
    number = value.try_cast("decimal(38,0)")
    stats = cells.groupBy("ordinal").agg(
        F.count("*").alias("total_rows"),
        F.count("value").alias("non_null"),
        F.coalesce(F.min(F.when(filled, F.length(value))), F.lit(0)).alias("min_length"),
        F.coalesce(F.max(F.when(filled, F.length(value))), F.lit(0)).alias("max_length"),
        F.max(F.abs(amount)).alias("max_abs"),
        (F.count_if(amount != F.round(amount, 2)) > 0).alias("needs_precision"),
        (F.count_if(F.contains(value, F.lit(":"))) > 0).alias("has_time"),
        F.count_if(filled).alias("filled_rows"),
        F.min(number).alias("min_int"),
        F.max(number).alias("max_int"),
        _few_values(F.when(filled, value), STATUS_DOMAIN).alias("_few"),
    )
    # Only values with a slash can be dates of these exports.
    dated = filled & F.contains(value, F.lit("/"))
    distinct = _distinct_counts(
        cells,
        unique_values=F.lit(True),
        filled_values=filled,
        dates=F.when(dated, parse_date(value).isNotNull()),
        times=F.when(dated, parse_timestamp(value).isNotNull()),
    )
    counts = ["unique_values", "filled_values", "dates", "times"]
    joined = _named(stats.join(distinct, F.col("ordinal") == F.col("_at"), "left").drop("_at"), columns)
    joined = joined.withColumns({name: F.coalesce(name, F.lit(0)).cast("long") for name in counts})
    few = F.when(F.col("filled_values").between(1, STATUS_DOMAIN), F.col("_few"))
    return joined.withColumn("domain", F.coalesce(few, F.array().cast("array<string>"))).drop("_few")


STATS = [
    "ordinal", "column", "total_rows", "non_null", "unique_values", "min_length", "max_length", "max_abs", "needs_precision",
    "has_time", "filled_values", "filled_rows", "dates", "times", "min_int", "max_int",
]


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The numbers the type rules look at, one row per column: what rows say, and how many distinct values say it."""
    return _measured(df, columns).select(*STATS)


def _quoted_list(values: Column) -> Column:
    return F.concat_ws(", ", F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'"))))


def _sized(width: Column) -> Column:
    return F.concat(F.lit("VARCHAR("), width.cast("string"), F.lit(")"))


def _first(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = F.when(rules[0][0], rules[0][1])
    for condition, value in rules[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def text_type(name: Column) -> Column:
    """Recommended type of a text column, from its name and statistics."""
    widest, unique, total = F.col("max_length"), F.col("unique_values"), F.col("total_rows")
    required = F.when(F.col("non_null") == total, " NOT NULL").otherwise("")

    def named(*words: str) -> Column:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(name, F.lit(word))
        return hit

    domain = F.col("domain")
    listed = _quoted_list(domain)
    check = F.concat(F.lit(' CHECK ("'), name, F.lit('" IN ('), listed, F.lit("))"))

    empty = _first([(named(word), F.lit(kind)) for word, kind in EMPTY_WIDTHS], F.lit("VARCHAR(50)"))

    identifier = F.concat(
        _sized(F.least(widest + 10, F.lit(64))), F.when(unique == total, " PRIMARY KEY").otherwise(required)
    )
    status = F.concat(
        _sized(widest + 5),
        F.when((unique <= STATUS_DOMAIN) & (F.size(domain) > 0), check).otherwise(""),
        required,
    )
    precise = F.when(F.col("needs_precision"), "4").otherwise("2")
    bands = [
        (F.col("max_abs") < upper, F.concat(F.lit(f"DECIMAL({digits},"), precise, F.lit(")")))
        for upper, digits in MONEY_BANDS
    ]
    money_type = F.concat(_first(bands, F.lit("DECIMAL(18,2)")), required)

    parsed = F.when(F.col("has_time"), F.col("times")).otherwise(F.col("dates"))
    all_parsed = (parsed == F.col("filled_values")) & (F.col("filled_values") > 0)
    date_type = F.concat(
        F.when(all_parsed & F.col("has_time"), "TIMESTAMP").when(all_parsed, "DATE").otherwise(_sized(widest)), required
    )

    few = F.col("filled_values").between(1, SMALL_DOMAIN - 1) & (unique < SMALL_DOMAIN)
    low = F.concat(
        _sized(widest + 10), F.when(few & (F.length(listed) < MAX_CHECK_LENGTH), check).otherwise("")
    )
    widths = [(widest <= upper, _sized(widest + extra)) for upper, extra in TEXT_BANDS]
    by_width = _first([*widths, (widest <= 255, F.lit("VARCHAR(255)"))], F.lit("TEXT"))
    plain = F.concat(
        F.when((unique < LOW_CARDINALITY) & (total > LOW_CARDINALITY_ROWS), low).otherwise(by_width), required
    )

    is_money = (name == "Total") | named(*MONEY_WORDS)
    is_date = named("Date") & ~named("Dollar")
    return _first(
        [
            (widest == 0, empty),
            (name.endswith(" #") | name.endswith("ID"), identifier),
            (name == "Status", status),
            (is_money, money_type),
            (is_date, date_type),
        ],
        plain,
    )


def integer_type() -> Column:
    low, high = F.col("min_int"), F.col("max_int")
    fits = [((low >= floor) & (high < ceiling), F.lit(kind)) for floor, ceiling, kind in INTEGER_BANDS]
    return _first(fits, F.lit("BIGINT"))


def exact_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Recommended exact type, nullability, distinct values and cardinality of every column."""
    names = list(columns or business_columns(df))
    kinds = {field.name: field.dataType.typeName() for field in df.schema}
    joined = _measured(df, names)
    required = F.when(F.col("non_null") == F.col("total_rows"), " NOT NULL").otherwise("")
    column = F.col("column")
    whole = [name for name in names if kinds[name] in ("byte", "short", "integer", "long")]
    other = {name: df.schema[name].dataType.simpleString().upper() for name in names if kinds[name] != "string" and name not in whole}
    exact = F.when(column.isin(whole), F.concat(integer_type(), required)) if whole else F.when(F.lit(False), "")
    for name, kind in other.items():
        exact = exact.when(column == name, F.concat(F.lit(kind), required))
    share = F.format_string("%.2f%%", (F.col("unique_values") / F.col("total_rows") * 100).cast("double"))
    no_text = (F.col("max_length") == 0) & column.isin([n for n in names if kinds[n] == "string"])
    return joined.select(
        "ordinal",
        "column",
        exact.otherwise(text_type(column)).alias("exact_type"),
        ((F.col("non_null") < F.col("total_rows")) | no_text).alias("nullable"),
        "unique_values",
        "total_rows",
        F.when(no_text, "0.00%").otherwise(share).alias("cardinality"),
    )


def domains(df: DataFrame, columns: Sequence[str], most: int = STATUS_DOMAIN) -> DataFrame:
    """Sorted values of every column that has at most `most` of them."""
    names = list(columns)
    cells = _cells(df, names)
    filled = F.coalesce(F.col("value") != "", F.lit(False))
    listed = cells.groupBy("ordinal").agg(_few_values(F.when(filled, F.col("value")), most).alias("domain"))
    distinct = _distinct_counts(cells, unique_values=filled)
    joined = _named(listed.join(distinct, F.col("ordinal") == F.col("_at")), names)
    return joined.where(F.col("unique_values").between(1, most)).select("column", "unique_values", "domain")
