"""Expectations, metrics, profiles and key discovery over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.operators import keyed
from silverline.quality import expectations as Q
from silverline.quality import keys, profiling
from silverline.reports import shapes as S
from silverline.reports.shapes import flat, table
from silverline.reports.silver import NOW

DATASETS = ["purchase_orders", "contracts", "vendors", "bids"]
_SOURCES = {"purchase_orders": S.PO_SQL, "contracts": S.CONTRACTS_SQL, "vendors": S.VENDORS_SQL, "bids": S.BIDS_SQL}


def _results(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name in DATASETS:
        suite = Q.suite_for(name)
        part = Q.expectations(Q.measure(getattr(S, name)(spark, d), suite), suite)
        out = part if out is None else out.unionByName(part)
    return out


def null_rates(spark: SparkSession, d: str) -> DataFrame:
    """AGG-02: missing labels after a left join, and missing document fields."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return Q.null_rates(docs, ["text", "lang", "source", "quality", "toxic"])


def expectations(spark: SparkSession, d: str) -> DataFrame:
    """DQ-01 to DQ-05, DQ-09: all expectations of four datasets."""
    return flat(_results(spark, d), "kwargs")


def severity(spark: SparkSession, d: str) -> DataFrame:
    """DQ-07, DQ-08: status and counters per dataset."""
    return flat(Q.severity(_results(spark, d)))


def worst_severity(spark: SparkSession, d: str) -> DataFrame:
    """DQ-07: the exit code over all datasets."""
    return flat(Q.worst(Q.severity(_results(spark, d))))


def failed_checks(spark: SparkSession, d: str) -> DataFrame:
    """DQ-08: failed checks in report form."""
    return flat(Q.failed_checks(_results(spark, d)).withColumn("threshold_percent", F.round("threshold_percent", 6)))


def allowed_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """DQ-03, DQ-04, AGG-08: uniqueness of consolidated orders that may repeat as often as the allowances say."""
    orders = S.purchase_orders(spark, d).where("trim(`PO #`) <> ''")
    repeated = orders.groupBy("PO #").agg(F.count("*").alias("n")).where("n > 1")
    # Orders whose number ends with an even digit may repeat twice at most, the others not at all.
    allowances = repeated.where("`PO #` rlike '[02468]$'").select("PO #", F.lit(2).alias("Duplicate Count"))
    kept = keyed.keep_last_n(orders, ["PO #"], ["source_row", "source_file_hash", "row_hash"], allowances, "Duplicate Count")
    suite = Q.suite_for("purchase_orders")
    out = None
    for given, rows in (("all", orders), ("consolidated", kept)):
        results = Q.expectations(Q.measure(rows, suite, allowances), suite).where(F.col("expectation_type").isin(Q.KEY_UNIQUE, Q.ROW_HASH_UNIQUE))
        part = results.select(F.lit(given).alias("given"), "expectation_type", "observed_value", "element_count", "unexpected_count", "unexpected_percent", "success")
        out = part if out is None else out.unionByName(part)
    return out


def validation_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """DQ-11: what manifests record of the validation of four datasets."""
    out = None
    for name in DATASETS:
        suite = Q.suite_for(name)
        stats = Q.measure(getattr(S, name)(spark, d), suite)
        part = Q.validation_outcome(Q.expectations(stats, suite), stats, suite, S.NOW)
        out = part if out is None else out.unionByName(part)
    return out.select(
        "dataset", "status", "passed", "has_warnings", "evaluated_expectations", "successful_expectations",
        F.concat_ws("~", F.transform("failures", lambda x: x["type"])).alias("failures"),
        F.concat_ws("~", F.transform("warnings", lambda x: F.concat_ws(":", x["type"], F.get_json_object(x["kwargs"], "$.column")))).alias("warnings"),
        F.col("volume.row_count").alias("row_count"), F.col("volume.unique_rows").alias("unique_rows"), F.col("freshness.ingestion_days").alias("ingestion_days"),
    )


def volume(spark: SparkSession, d: str) -> DataFrame:
    """AGG-01, AGG-03, AGG-06: rows, distinct rows, bytes."""
    return flat(Q.volume_metrics(Q.measure(S.purchase_orders(spark, d), Q.suite_for("purchase_orders"))))


def freshness(spark: SparkSession, d: str) -> DataFrame:
    """AGG-04: first and last ingestion, age, days."""
    return flat(Q.freshness_metrics(Q.measure(S.bids(spark, d), Q.suite_for("bids")), S.NOW))


def service_levels(spark: SparkSession, d: str) -> DataFrame:
    """DQ-10: strict completeness, freshness and uniqueness against targets."""
    suite = Q.suite_for("bids")
    return Q.service_levels(Q.measure(S.bids(spark, d), suite), suite, S.NOW)


def key_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """AGG-01: rows against distinct compound keys."""
    return Q.key_duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def required_rows(spark: SparkSession, d: str) -> DataFrame:
    """DQ-06: minimum row counts."""
    rows = table(spark, d, "pages").agg(F.count("*").alias("row_count"))
    return Q.has_required_rows(rows, 100)


def content_consistency(spark: SparkSession, d: str) -> DataFrame:
    """AGG-05: distinct source hashes per file."""
    rows = S.purchase_orders(spark, d).groupBy("source_file").agg(F.count_distinct("source_file_hash").alias("source_hashes"))
    return rows.withColumn("consistent", F.col("source_hashes") == 1)


def column_profile(spark: SparkSession, d: str) -> DataFrame:
    """PRF-03, AGG-12, SRT-07: missing values, distinct values and samples per column."""
    rows = S.bids(spark, d)
    profile = profiling.column_profile(rows, Q.suite_for("bids").columns)
    return flat(profile.withColumn("sample_values", F.concat_ws("~", "sample_values")))


def column_stats(spark: SparkSession, d: str) -> DataFrame:
    """AGG-13 to AGG-16: lengths, amounts, dates and integer ranges per column."""
    rows = profiling.column_stats(S.purchase_orders(spark, d), Q.suite_for("purchase_orders").columns)
    return flat(rows, "ordinal", "filled_values", "filled_rows")


def exact_types(spark: SparkSession, d: str) -> DataFrame:
    """PRF-01, PRF-02: recommended types of purchase orders and parts."""
    orders = profiling.exact_types(S.purchase_orders(spark, d))
    parts = profiling.exact_types(table(spark, d, "part"))
    return flat(orders.unionByName(parts), "ordinal")


def domains(spark: SparkSession, d: str) -> DataFrame:
    """AGG-17: values of columns that have few of them."""
    orders = table(spark, d, "orders")
    rows = profiling.domains(orders, orders.columns)
    return rows.withColumn("domain", F.concat_ws("~", "domain"))


def key_discovery(spark: SparkSession, d: str) -> DataFrame:
    """PRF-04: distinct counts of all combinations of all columns."""
    return flat(keys.combination_counts(table(spark, d, "lineitem")), "source")


def key_matches(spark: SparkSession, d: str) -> DataFrame:
    """PRF-04: combinations of all columns that identify a row, or nearly do, found by sketches."""
    return flat(keys.near_counts(table(spark, d, "customer")), "total_rows")


def near_key_matches(spark: SparkSession, d: str) -> DataFrame:
    """PRF-04: combinations of all columns with as many values as there are distinct orders, within a twentieth, found by sketches."""
    lines = table(spark, d, "lineitem")
    orders = lines.select("l_orderkey").distinct().count()
    return flat(keys.near_counts(lines, orders, orders // 20), "total_rows")


def common_counts(spark: SparkSession, d: str) -> DataFrame:
    """PRF-05, SRT-04: distinct counts that many combinations of all columns share."""
    return keys.common_counts(keys.combination_counts(table(spark, d, "orders")))


def closest_counts(spark: SparkSession, d: str) -> DataFrame:
    """SRT-04: combinations of all columns nearest to a target count."""
    orders = table(spark, d, "orders")
    target = orders.select("o_custkey").distinct().count()
    return flat(keys.closest(keys.combination_counts(orders), target, 3), "source", "total_rows")


def key_matches_all_columns(spark: SparkSession, d: str) -> DataFrame:
    """PRF-04: as `key_matches`, from the exact counts of all combinations."""
    return flat(keys.matches(keys.combination_counts(table(spark, d, "customer"))), "source", "total_rows")


QUERIES = {
    "null_rates": null_rates, "expectations": expectations, "severity": severity, "worst_severity": worst_severity,
    "allowed_duplicates": allowed_duplicates, "validation_outcomes": validation_outcomes,
    "failed_checks": failed_checks, "volume": volume, "freshness": freshness, "service_levels": service_levels,
    "key_duplicates": key_duplicates, "required_rows": required_rows, "content_consistency": content_consistency,
    "column_profile": column_profile, "column_stats": column_stats, "exact_types": exact_types, "domains": domains,
    "key_discovery": key_discovery, "key_matches": key_matches, "common_counts": common_counts,
    "closest_counts": closest_counts, "near_key_matches": near_key_matches, "key_discovery_all_columns": key_discovery,
    "key_matches_all_columns": key_matches_all_columns, "common_counts_all_columns": common_counts,
    "closest_counts_all_columns": closest_counts,
}


def _expectations_sql() -> str:
    parts = []
    for name in DATASETS:
        suite = Q.suite_for(name)
        key = f'"{suite.primary_key[0]}"'
        src = _SOURCES[name]
        head = f"'{name}' AS dataset"
        parts.append(
            f"SELECT {head}, '{Q.ROW_COUNT}' AS expectation_type, NULL AS \"column\", CAST(count(*) AS DOUBLE) AS observed_value, "
            f"count(*) AS element_count, CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent, "
            f"count(*) BETWEEN 1 AND 10000000 AS success, true AS critical FROM {src} t"
        )
        for column in suite.columns:
            limit = suite.null_rate_max.get(column, 0.5)
            parts.append(
                f"SELECT {head}, '{Q.NOT_NULL}', '{column}', CAST(count(\"{column}\") AS DOUBLE), count(*), count(*) - count(\"{column}\"), "
                f"(count(*) - count(\"{column}\"))::DOUBLE / count(*)::DOUBLE * 100, (count(*) - count(\"{column}\")) / count(*) <= {limit}, false FROM {src} t"
            )
        for kind, distinct in ((Q.KEY_UNIQUE, f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {src} u))"), (Q.ROW_HASH_UNIQUE, "count(DISTINCT row_hash)")):
            parts.append(
                f"SELECT {head}, '{kind}', NULL, CAST({distinct} AS DOUBLE), count(*), count(*) - {distinct}, "
                f"(count(*) - {distinct})::DOUBLE / count(*)::DOUBLE * 100, count(*) = {distinct}, false FROM {src} t"
            )
        parts.append(
            f"SELECT {head}, '{Q.CONTENT_HASH}', NULL, CAST(count(DISTINCT source_file_hash) AS DOUBLE), count(*), NULL, NULL, "
            f"count(DISTINCT source_file_hash) = 1, true FROM {src} t"
        )
    return "\nUNION ALL ".join(parts)


_EXPECT = _expectations_sql()
_SEVERITY = f"""
SELECT dataset, count(*) AS evaluated_expectations, count(*) FILTER (success) AS successful_expectations,
       count(*) FILTER (NOT success) AS unsuccessful_expectations, count(*) FILTER (NOT success AND critical) AS critical_failures,
       CASE WHEN bool_or(NOT success AND critical) THEN 'failed' WHEN bool_or(NOT success) THEN 'warning' ELSE 'healthy' END AS status,
       CAST(CASE WHEN bool_or(NOT success AND critical) THEN 2 ELSE 0 END AS BIGINT) AS exit_code,
       NOT bool_or(NOT success AND critical) AS passed, bool_or(NOT success AND NOT critical) AS has_warnings
FROM ({_EXPECT}) GROUP BY dataset"""


def _combos(table_name: str, columns: list[str]) -> str:
    from itertools import combinations

    parts = []
    for size in range(1, len(columns) + 1):
        for combo in combinations(columns, size):
            listed = ", ".join(combo)
            parts.append(
                f"SELECT '{' + '.join(combo)}' AS columns, {size}::BIGINT AS size, (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {table_name})) AS unique_count"
            )
    return " UNION ALL ".join(parts)


def _cube(table_name: str, columns: list[str]) -> str:
    """Like `_combos`, in one pass over all combinations."""
    listed, names = ", ".join(columns), ", ".join(f"'{c}'" for c in columns)
    chosen = f"list_filter([{names}], lambda x, i: (m >> ({len(columns)} - i)) & 1 = 0)"
    return f"""
SELECT array_to_string({chosen}, ' + ') AS columns, len({chosen}) AS size, unique_count
FROM (SELECT m, count(*) AS unique_count FROM (SELECT grouping({listed}) AS m FROM {table_name} GROUP BY CUBE ({listed})) GROUP BY m)
WHERE m <> {2 ** len(columns) - 1}"""


def _stats_sql(column: str) -> str:
    v = f'"{column}"'
    amount = f"TRY_CAST(translate({v}, '$,', '') AS DECIMAL(38,4))"
    whole = f"CASE WHEN regexp_full_match({v}, '[0-9]+') THEN CAST({v} AS DOUBLE) END"
    return f"""
SELECT '{column}' AS "column", count(*) AS total_rows, count({v}) AS non_null, count(DISTINCT {v}) AS unique_values,
       coalesce(min(length({v})) FILTER ({v} <> ''), 0) AS min_length, coalesce(max(length({v})) FILTER ({v} <> ''), 0) AS max_length,
       CAST(max(abs({amount})) AS DOUBLE) AS max_abs, coalesce(bool_or({amount} <> round({amount}, 2)), false) AS needs_precision,
       coalesce(bool_or(contains({v}, ':')), false) AS has_time,
       count(DISTINCT {v}) FILTER (try_strptime({v}, '%m/%d/%Y') IS NOT NULL) AS dates,
       count(DISTINCT {v}) FILTER (try_strptime({v}, '%m/%d/%Y %H:%M:%S') IS NOT NULL) AS times,
       CAST(min(TRY_CAST({v} AS DECIMAL(38,0))) AS DOUBLE) AS min_int, CAST(max(TRY_CAST({v} AS DECIMAL(38,0))) AS DOUBLE) AS max_int
FROM {S.PO_SQL} p"""


def _profile_sql(i: int, column: str) -> str:
    v = f'"{column}"'
    return f"""
SELECT {i}::BIGINT AS ordinal, '{column}' AS "column", count(*) AS total_rows, count(*) FILTER (coalesce(trim({v}), '') = '') AS null_count,
       CAST(count(*) FILTER (coalesce(trim({v}), '') = '') * 100 / count(*) AS DOUBLE) AS null_percent,
       count(DISTINCT {v}) FILTER (trim({v}) <> '') AS unique_values,
       coalesce(array_to_string(list_sort(list(DISTINCT {v}) FILTER (trim({v}) <> ''))[:3], '~'), '') AS sample_values
FROM {S.BIDS_SQL} b"""


def _domain_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(DISTINCT {column}) AS unique_values,
       array_to_string(list_sort(list(DISTINCT CAST({column} AS VARCHAR))), '~') AS domain FROM orders HAVING count(DISTINCT {column}) <= 20"""


def _type_sql(column: str, source: str, kind: str) -> str:
    """Type rules for one column, chosen here by its name."""
    v = f'"{column}"'
    pct = f"printf('%.2f%%', round(count(DISTINCT {v}) / count(*) * 100, 2))"
    req = f"CASE WHEN count({v}) = count(*) THEN ' NOT NULL' ELSE '' END"
    width = f"coalesce(max(length({v})) FILTER ({v} <> ''), 0)"
    values = f"list_sort(list(DISTINCT {v}) FILTER ({v} <> ''))"
    listed = f"array_to_string(list_transform({values}, lambda x: '''' || x || ''''), ', ')"
    check = f"' CHECK (\"{column}\" IN (' || {listed} || '))'"

    def sized(e: str) -> str:
        return f"'VARCHAR(' || ({e}) || ')'"

    if kind == "int":
        exact = f"""CASE WHEN min({v}) >= 0 AND max({v}) < 256 THEN 'UTINYINT' WHEN min({v}) >= -128 AND max({v}) < 128 THEN 'TINYINT'
            WHEN min({v}) >= 0 AND max({v}) < 65536 THEN 'USMALLINT' WHEN min({v}) >= -32768 AND max({v}) < 32768 THEN 'SMALLINT'
            WHEN min({v}) >= 0 AND max({v}) < 4294967296 THEN 'UINTEGER' ELSE 'BIGINT' END || {req}"""
    elif kind == "double":
        exact = f"'DOUBLE' || {req}"
    elif kind == "id":
        exact = f"{sized(f'least({width} + 10, 64)')} || CASE WHEN count(DISTINCT {v}) = count(*) THEN ' PRIMARY KEY' ELSE {req} END"
    elif kind == "status":
        exact = f"{sized(f'{width} + 5')} || CASE WHEN count(DISTINCT {v}) <= 20 THEN {check} ELSE '' END || {req}"
    elif kind == "money":
        a = f"max(abs(TRY_CAST(translate({v}, '$,', '') AS DECIMAL(38,4))))"
        exact = f"""CASE WHEN {a} < 1e4 THEN 'DECIMAL(8,2)' WHEN {a} < 1e6 THEN 'DECIMAL(10,2)' WHEN {a} < 1e8 THEN 'DECIMAL(12,2)'
            WHEN {a} < 1e10 THEN 'DECIMAL(15,2)' ELSE 'DECIMAL(18,2)' END || {req}"""
    elif kind == "date":
        ok = f"count(*) FILTER ({v} <> '' AND try_strptime({v}, '%m/%d/%Y') IS NULL) = 0"
        exact = f"CASE WHEN {ok} THEN 'DATE' ELSE {sized(width)} END || {req}"
    else:
        low = f"{sized(f'{width} + 10')} || CASE WHEN count(DISTINCT {v}) < 10 AND length({listed}) < 500 THEN {check} ELSE '' END"
        wide = f"""CASE WHEN {width} <= 32 THEN {sized(f'{width} + 8')} WHEN {width} <= 64 THEN {sized(f'{width} + 16')}
            WHEN {width} <= 128 THEN {sized(f'{width} + 32')} WHEN {width} <= 255 THEN 'VARCHAR(255)' ELSE 'TEXT' END"""
        exact = f"CASE WHEN count(DISTINCT {v}) < 50 AND count(*) > 100 THEN {low} ELSE {wide} END || {req}"
    return f"""SELECT '{column}' AS "column", {exact} AS exact_type, count({v}) < count(*) AS nullable,
       count(DISTINCT {v}) AS unique_values, count(*) AS total_rows, {pct} AS cardinality FROM {source} t"""


_PO_KINDS = {
    "PO #": "id", "Description": "text", "Vendor": "text", "Organization": "text", "Department": "text", "Buyer": "text",
    "Status": "status", "Sent Date": "date", "Total": "money",
}
_PART_KINDS = {"p_partkey": "int", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "int", "p_retailprice": "double"}
_LINEITEM = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
_CUSTOMER = "c_custkey c_name c_nationkey c_acctbal c_mktsegment".split()
_ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
_STRICT = ", ".join(f'"{c}"' for c in Q.STRICT_COLUMNS["bids"])
_NULLS = " + ".join(f'(count(*) - count("{c}"))' for c in Q.STRICT_COLUMNS["bids"])
_ALL_COUNTS = f"SELECT *, (SELECT count(*) FROM lineitem) AS total_rows FROM ({_cube('lineitem', _LINEITEM)})"
_KEYS_OF_CUSTOMERS = f"""
SELECT columns, size, unique_count, unique_count - n AS diff, CASE WHEN unique_count = n THEN 'exact' ELSE 'close' END AS match
FROM ({_cube('customer', _CUSTOMER)}), (SELECT count(*) AS n FROM customer) WHERE abs(unique_count - n) <= 5"""
_COMMON_COUNTS = f"""
SELECT unique_count, count(*) AS combinations FROM ({_cube('orders', _ORDERS)}) GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 5"""
_CLOSEST_COUNTS = f"""
SELECT columns, size, unique_count, unique_count - n AS diff
FROM (SELECT count(DISTINCT o_custkey) AS n FROM orders), ({_cube('orders', _ORDERS)}) ORDER BY abs(unique_count - n), columns LIMIT 3"""

SQL = {
    "null_rates": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"(count(*) - count({c}))::DOUBLE / count(*)::DOUBLE AS null_rate FROM documents LEFT JOIN labels USING (doc_id)"
        for c in ("text", "lang", "source", "quality", "toxic")
    ),
    "expectations": _EXPECT,
    "severity": _SEVERITY,
    "worst_severity": f"SELECT max(exit_code) AS exit_code FROM ({_SEVERITY})",
    "allowed_duplicates": f"""
WITH orders AS (SELECT * FROM {S.PO_SQL} p WHERE trim("PO #") <> ''),
allowed AS (SELECT "PO #" AS k, 2 AS n FROM orders WHERE regexp_matches("PO #", '[02468]$') GROUP BY 1 HAVING count(*) > 1),
kept AS (SELECT orders.* FROM orders LEFT JOIN allowed ON k = "PO #"
         QUALIFY row_number() OVER (PARTITION BY "PO #" ORDER BY source_row DESC, source_file_hash DESC, row_hash DESC) <= coalesce(n, 1)),
counts AS (
  SELECT 'all' AS given, count(*) AS rows, count(DISTINCT "PO #") AS keys, count(DISTINCT row_hash) AS hashes FROM orders UNION ALL
  SELECT 'consolidated', count(*), count(DISTINCT "PO #"), count(DISTINCT row_hash) FROM kept)
SELECT given, kind AS expectation_type, u::DOUBLE AS observed_value, rows AS element_count, abs(rows - u - extra) AS unexpected_count,
       abs(rows - u - extra)::DOUBLE / rows::DOUBLE * 100 AS unexpected_percent, rows - u = extra AS success
FROM (SELECT given, rows, unnest([keys, hashes]) AS u, unnest(['{Q.KEY_UNIQUE}', '{Q.ROW_HASH_UNIQUE}']) AS kind FROM counts),
     (SELECT coalesce(sum(n - 1), 0)::BIGINT AS extra FROM allowed)""",
    "validation_outcomes": f"""
SELECT dataset, CASE WHEN count(*) FILTER (NOT success AND critical) > 0 THEN 'failed' WHEN count(*) FILTER (NOT success) > 0 THEN 'warning' ELSE 'healthy' END AS status,
       count(*) FILTER (NOT success AND critical) = 0 AS passed, count(*) FILTER (NOT success AND NOT critical) > 0 AS has_warnings,
       count(*) AS evaluated_expectations, count(*) FILTER (success) AS successful_expectations,
       coalesce(string_agg(expectation_type, '~' ORDER BY expectation_type) FILTER (NOT success AND critical), '') AS failures,
       coalesce(string_agg(concat_ws(':', expectation_type, "column"), '~' ORDER BY expectation_type, "column") FILTER (NOT success AND NOT critical), '') AS warnings,
       any_value(n) AS row_count, any_value(u) AS unique_rows, any_value(days) AS ingestion_days
FROM ({_EXPECT}) JOIN ({' UNION ALL '.join(
    f"SELECT '{name}' AS dataset, count(*) AS n, count(DISTINCT row_hash) AS u, count(DISTINCT ingested_at::DATE) AS days FROM {source} t" for name, source in _SOURCES.items()
)}) USING (dataset) GROUP BY dataset""",
    "failed_checks": f"""
SELECT e.dataset, replace(expectation_type, 'expect_', '') AS type, "column",
       CASE WHEN "column" IS NOT NULL THEN unexpected_percent END AS null_percent,
       CASE WHEN "column" IS NOT NULL THEN coalesce(t.pct, 50.0)::DOUBLE END AS threshold_percent,
       CASE WHEN "column" IS NULL THEN observed_value END AS observed, critical
FROM ({_EXPECT}) e LEFT JOIN (VALUES {', '.join(f"('{ds}', '{c}', {v * 100}::DOUBLE)" for ds, m in Q.NULL_RATES.items() for c, v in m.items())}) t(dataset, c, pct)
  ON e.dataset = t.dataset AND e."column" = t.c
WHERE NOT success""",
    "volume": f"""
SELECT count(*) AS row_count, count(DISTINCT row_hash) AS unique_rows, count(*) - count(DISTINCT row_hash) AS duplicate_rows,
       min(source_file_bytes) AS bytes_min, max(source_file_bytes) AS bytes_max, avg(source_file_bytes) AS bytes_avg FROM {S.PO_SQL} p""",
    "freshness": f"""
SELECT strftime(min(ingested_at), '%Y-%m-%d %H:%M:%S') AS first_ingested, strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S') AS last_ingested,
       CAST(trunc(epoch({NOW}) - epoch(max(ingested_at))) / 3600 AS DOUBLE) AS age_hours, count(DISTINCT CAST(ingested_at AS DATE)) AS ingestion_days FROM {S.BIDS_SQL} b""",
    "service_levels": f"""
WITH m AS (SELECT ({_NULLS})::DOUBLE / (count(*) * {len(Q.STRICT_COLUMNS['bids'])})::DOUBLE AS nulls,
                  1 - (SELECT count(*) FROM (SELECT DISTINCT "Bid Solicitation #" FROM {S.BIDS_SQL} u))::DOUBLE / count(*)::DOUBLE AS dup,
                  trunc(epoch({NOW}) - epoch(max(ingested_at))) / 3600 AS age FROM {S.BIDS_SQL} b)
SELECT 'bids' AS dataset, 'completeness' AS measure, 1 - nulls AS value, 1 - nulls >= 0.99 AS target_met,
       CASE WHEN nulls > 0.9 THEN 'critical' WHEN nulls > 0.5 THEN 'warning' ELSE 'ok' END AS state FROM m
UNION ALL SELECT 'bids', 'freshness_hours', age, age <= 24, CASE WHEN age > 72 THEN 'critical' WHEN age > 24 THEN 'warning' ELSE 'ok' END FROM m
UNION ALL SELECT 'bids', 'uniqueness', 1 - dup, 1 - dup >= 1, CASE WHEN dup > 0.5 THEN 'critical' WHEN dup > 0.1 THEN 'warning' ELSE 'ok' END FROM m""",
    "key_duplicates": """
SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS unique_keys,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_rows FROM lineitem""",
    "required_rows": "SELECT count(*) AS row_count, count(*) >= 100 AS valid FROM pages",
    "content_consistency": f"""
SELECT source_file, count(DISTINCT source_file_hash) AS source_hashes, count(DISTINCT source_file_hash) = 1 AS consistent
FROM {S.PO_SQL} p GROUP BY 1""",
    "column_profile": " UNION ALL ".join(_profile_sql(i, c) for i, c in enumerate(Q.suite_for("bids").columns)),
    "column_stats": " UNION ALL ".join(_stats_sql(c) for c in Q.suite_for("purchase_orders").columns),
    "exact_types": " UNION ALL ".join(
        [_type_sql(c, S.PO_SQL, k) for c, k in _PO_KINDS.items()] + [_type_sql(c, "part", k) for c, k in _PART_KINDS.items()]
    ),
    "domains": " UNION ALL ".join(_domain_sql(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")),
    "key_discovery": _ALL_COUNTS,
    "key_matches": _KEYS_OF_CUSTOMERS,
    "near_key_matches": f"""
SELECT columns, size, unique_count, unique_count - n AS diff, CASE WHEN unique_count = n THEN 'exact' ELSE 'close' END AS match
FROM ({_cube('lineitem', _LINEITEM)}), (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem) WHERE abs(unique_count - n) <= n // 20""",
    "common_counts": _COMMON_COUNTS,
    "closest_counts": _CLOSEST_COUNTS,
    "key_discovery_all_columns": _ALL_COUNTS,
    "key_matches_all_columns": _KEYS_OF_CUSTOMERS,
    "common_counts_all_columns": _COMMON_COUNTS,
    "closest_counts_all_columns": _CLOSEST_COUNTS,
}
