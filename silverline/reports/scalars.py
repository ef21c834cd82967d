"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions import dates, links, numbers, rules, text
from silverline.operators.joins import in_ranges
from silverline.reports import shapes as S
from silverline.reports.shapes import flat, table
from silverline.reports.silver import TODAY, fq, fy, keyword_case
from silverline.sources.readers import path_fields
from silverline.plans.silver.common import raw

DAY_SQL = "CAST(o_orderdate + INTERVAL 24 YEAR AS DATE)"


def _order_days(spark: SparkSession, d: str) -> DataFrame:
    day = (F.col("o_orderdate") + F.expr("interval 24 year")).cast("date")
    return table(spark, d, "orders").withColumn("day", day)


def amount_bands(spark: SparkSession, d: str) -> DataFrame:
    """NUM-01, NUM-03, CND-03: parsed amounts and their bands."""
    amount = numbers.money(raw("Total"), 15)
    rows = S.purchase_orders(spark, d).select(
        "source_row",
        amount.alias("amount"),
        F.coalesce(amount, F.lit(0).cast("decimal(15,2)")).alias("amount_or_zero"),
        rules.amount_band(amount).alias("band"),
        rules.amount_band(amount, strict=True).alias("strict_band"),
    )
    return flat(rows)


def keyword_classes(spark: SparkSession, d: str) -> DataFrame:
    """CND-02, STR-09: first-match keyword classes of part names and types."""
    table_rules = [("Metal", ["steel", "nickel", "copper", "brass", "tin"]), ("Small", ["SMALL", "mini"]), ("Promo", ["PROMO%"])]
    described = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    return table(spark, d, "part").select(
        "p_partkey",
        rules.first_match(described, table_rules).alias("class"),
        rules.first_match(described, table_rules, ignore_case=False).alias("cased_class"),
        rules.contains_any(F.col("p_type"), ["ECONOMY", "STANDARD"], ignore_case=False).alias("is_basic"),
    )


_PART_RULES = [("Metal", ["steel", "nickel", "copper", "brass", "tin"]), ("Small", ["SMALL", "mini"]), ("Promo", ["PROMO%"])]
_PART_TEXT = "concat_ws(' ', p_name, p_type, p_brand)"


def phone_classes(spark: SparkSession, d: str) -> DataFrame:
    """CND-08, STR-07, STR-08, STR-14: phone digits and classes, first-only replacement, clean names."""
    phone = raw("Phone")
    digits = text.digits(phone)
    return S.vendors(spark, d).select(
        "source_row",
        digits.alias("digits"),
        text.drop_first_non_digit(phone).alias("first_dropped"),
        rules.phone_type(phone, digits).alias("phone_type"),
        text.match_name(raw("Vendor Name")).alias("clean_name"),
    )


def fiscal_calendar(spark: SparkSession, d: str) -> DataFrame:
    """DAT-03, DAT-06, DAT-11: fiscal and calendar parts of every order day."""
    day = F.col("day")
    rows = _order_days(spark, d).groupBy("day").agg(F.count("*").alias("orders"))
    return flat(
        rows.select(
            day, "orders",
            dates.fiscal_year(day).alias("fiscal_year"), dates.fiscal_quarter(day).alias("fiscal_quarter"),
            F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
            F.date_format(day, "yyyy").alias("year_text"), F.date_format(day, "MM").alias("month_text"),
        )
    )


def business_hours(spark: SparkSession, d: str) -> DataFrame:
    """DAT-04, DAT-05: weekday, hour and business-hours flag per event group."""
    ts = F.col("ts")
    return flat(
        table(spark, d, "events")
        .groupBy(
            dates.day_index(ts).alias("dow"), dates.day_name(ts).alias("day_name"), F.hour(ts).alias("hour"),
            dates.in_business_hours(ts).alias("business_hours"),
        )
        .agg(F.count("*").alias("events"))
    )


def date_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    """DAT-07 to DAT-10, NUM-04, CND-04: differences, shifts, least, guarded rate, temporal state."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    a, b = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    today = F.lit("1998-06-30").cast("date")
    grouped = joined.groupBy(a.alias("start"), b.alias("end")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spent")
    )
    a, b = F.col("start"), F.col("end")
    days = dates.days_between(a, F.least(today, b))
    state = F.when(today < a, "Future").when(today > b, "Expired").otherwise("Active")
    return flat(
        grouped.select(
            "start", "end", "spent", dates.days_between(a, b).alias("days"),
            dates.month_boundaries(a, b).alias("months"), dates.year_boundaries(a, b).alias("years"),
            dates.shifted(b, 30).alias("end_plus_30"), days.alias("elapsed"),
            numbers.rounded_ratio(F.col("spent"), days, 18).alias("rate"), state.alias("state"),
        )
    )


def row_hash(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-03, STR-13, COL-01: whole-row and first-column hashes."""
    rows = table(spark, d, "customer")
    return rows.select(
        "c_custkey",
        text.row_hash(rows.columns).alias("row_hash"),
        text.row_hash(rows.columns, mode="first_column").alias("key_hash"),
        F.sha2(F.col("c_name"), 256).alias("name_sha256"),
    )


def change_detection(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-02, PRJ-03: order lines that changed between the first and the last version."""
    lines = table(spark, d, "lineitem")
    columns = [name for name in lines.columns if name not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    hashed = lines.select("l_orderkey", "l_linenumber", "l_shipdate", text.row_hash(columns).alias("h"))
    at = F.struct("l_shipdate", "h")
    grouped = hashed.groupBy("l_orderkey", "l_linenumber").agg(
        F.min_by("h", at).alias("first_hash"), F.max_by("h", at).alias("last_hash"), F.count("*").alias("versions")
    )
    changed = grouped.where("first_hash <> last_hash")
    return flat(changed)


def url_build(spark: SparkSession, d: str) -> DataFrame:
    """STR-15, STR-16, FLT-11: links, base ids and id checks of purchase orders."""
    key = raw("PO #")
    return S.purchase_orders(spark, d).select(
        "source_row",
        links.record_link(key, "purchase_order").alias("po_url"),
        links.record_link(text.base_id(key, ":"), "contract").alias("contract_url"),
        links.holder_list_link(key, F.when(F.col("source_row") % 2 == 0, "View List")).alias("holder_list_url"),
        links.has_valid_id(key, "purchase_order").alias("valid_po"),
        links.has_valid_id(key, "contract").alias("valid_contract"),
    )


_BID = """concat('https://portal.example/bso/external/bidAckList.sdo?bidId=', replace(trim("PO #"), ' ', '+'))"""
_PO_LINK = """'https://portal.example/bso/external/purchaseorder/poSummary.sdo?docId=' || replace({x}, ' ', '+') || '&releaseNbr=0&external=true&parentUrl=close'"""


def vendor_ids(spark: SparkSession, d: str) -> DataFrame:
    """FLT-11, STR-15: vendor and bid id checks."""
    vendors = S.vendors(spark, d).select(raw("Vendor ID").alias("id"), "source_row")
    bids = S.bids(spark, d).select(raw("Bid Solicitation #").alias("id"), "source_row")
    return (
        vendors.select("source_row", links.record_link(F.col("id"), "vendor").alias("url"), links.has_valid_id(F.col("id"), "vendor").alias("valid"))
        .unionByName(
            bids.select("source_row", links.record_link(F.col("id"), "bid_detail").alias("url"), links.has_valid_id(F.col("id"), "bid_detail").alias("valid"))
        )
    )


def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """SRC-08, STR-17: date, run id and file name from paths."""
    stamp = F.date_format("ts", "yyyy/MM/dd")
    folder = F.when(F.col("event_id") % 7 == 0, F.lit("misc")).otherwise(F.concat(F.lit("run_"), F.col("user_id").cast("string")))
    where = F.when(F.col("event_id") % 5 == 0, F.lit("undated")).otherwise(stamp)
    rows = table(spark, d, "events").select("event_id", F.concat_ws("/", F.lit("raw"), where, folder, F.lit("files"), F.concat("event_type", F.lit(".csv"))).alias("path"))
    fields = path_fields(F.col("path"), F.lit("2024-02-02").cast("date"))
    return flat(rows.select("event_id", *[value.alias(name) for name, value in fields.items()]))


def json_props(spark: SparkSession, d: str) -> DataFrame:
    """JSN-01: a field inside JSON text."""
    parsed = F.from_json("props", "k bigint")
    return table(spark, d, "events").select("event_id", parsed["k"].alias("k"), (parsed["k"] > 50).alias("is_high"))


def blank_values(spark: SparkSession, d: str) -> DataFrame:
    """STR-11, STR-12, CND-05, CND-06, PRJ-05, FLT-01: blanks, part counts, flags."""
    awarded, status = raw("Awarded Vendor(s)"), raw("Status")
    return flat(
        S.bids(spark, d).where(~text.is_missing(raw("Bid Solicitation #"), "blank")).select(
            "source_row", awarded.alias("raw_value"), text.blank_to_null(awarded).alias("clean_value"),
            text.part_count(awarded).alias("parts"), text.has_text(awarded).alias("has_text"),
            text.is_missing(awarded, "blank").alias("is_blank"),
            rules.three_way(status, ["Awarded"], ["Sent", "Open"]).alias("is_awarded"),
        )
    )


def date_checks(spark: SparkSession, d: str) -> DataFrame:
    """DAT-01, DAT-15, FLT-02, FLT-03, FLT-10, CND-07: valid dates, allowed ranges, future rows."""
    sent = raw("Sent Date")
    day = dates.parse_date(sent)
    return flat(
        S.purchase_orders(spark, d).select(
            "source_row", day.alias("day"), day.isNotNull().alias("has_valid_date"),
            dates.is_requestable(sent, S.ASOF, "2018-01-31").alias("bid_date_ok"),
            dates.is_requestable(sent, S.ASOF, "2014-01-01").alias("contract_date_ok"),
            dates.is_requestable(sent, S.ASOF, latest="asof+1y").alias("po_date_ok"),
            F.coalesce(day > F.lit(S.ASOF), F.lit(False)).alias("in_future"),
        )
    )


def interval_filter(spark: SparkSession, d: str) -> DataFrame:
    """FLT-04, FLT-08, FLT-09: contracts with a sane period and a known amount."""
    begin, end = dates.parse_date(raw("Begin Date")), dates.parse_date(raw("End Date"))
    rows = S.contracts(spark, d).where((begin <= end) & (numbers.money(raw("Dollars Spent to Date"), 12) >= 0))
    return rows.where(~text.is_missing(raw("Contract #"), "blank")).select("source_row", raw("Contract #").alias("contract_id"))


def test_rows(spark: SparkSession, d: str) -> DataFrame:
    """FLT-05, FLT-06, FLT-07, STR-10: test data by case-sensitive, caseless and pattern match."""
    vendor = raw("Vendor")
    return S.purchase_orders(spark, d).select(
        "source_row",
        rules.contains_any(vendor, ["TEST", "DEMO"], ignore_case=False).alias("cased"),
        rules.contains_any(vendor, ["test", "do not use"]).alias("caseless"),
        vendor.rlike("TEST|DEMO|DO NOT USE").alias("by_pattern"),
    )


def small_numbers(spark: SparkSession, d: str) -> DataFrame:
    """NUM-02, STR-03, STR-04: revision numbers from record ids."""
    key = raw("PO #")
    return flat(
        S.purchase_orders(spark, d).select(
            "source_row", text.base_id(key, ":.").alias("base_id"),
            numbers.whole_number(text.revision_text(key, ":."), "smallint").alias("revision"),
            numbers.whole_number(text.revision_text(key, ":"), "int").alias("colon_revision"),
        )
    )


def range_join(spark: SparkSession, d: str) -> DataFrame:
    """JN-07: orders paired with overlapping date ranges, counted per range."""
    orders = _order_days(spark, d)
    ranges = orders.select(F.trunc("day", "year").alias("start_date")).distinct().select(
        F.concat(F.lit("from_"), F.year("start_date").cast("string")).alias("range_id"), "start_date",
        F.date_add("start_date", 400).alias("end_date"),
    )
    joined = in_ranges(orders.withColumnRenamed("day", "_on"), F.col("_on"), ranges)
    return joined.groupBy("range_id").agg(F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"))


QUERIES = {
    "amount_bands": amount_bands, "keyword_classes": keyword_classes, "phone_classes": phone_classes,
    "fiscal_calendar": fiscal_calendar, "business_hours": business_hours, "date_arithmetic": date_arithmetic,
    "row_hash": row_hash, "change_detection": change_detection, "url_build": url_build, "vendor_ids": vendor_ids,
    "path_parts": path_parts, "json_props": json_props, "blank_values": blank_values, "date_checks": date_checks,
    "interval_filter": interval_filter, "test_rows": test_rows, "small_numbers": small_numbers, "range_join": range_join,
}
_AMOUNT = "TRY_CAST(replace(replace(\"Total\", '$', ''), ',', '') AS DECIMAL(15,2))"
_BAND = (
    "CASE WHEN a = 0 THEN 'Zero' WHEN a < 1e3 THEN 'Micro (<$1K)' WHEN a < 1e4 THEN 'Small ($1K-$10K)' "
    "WHEN a < 1e5 THEN 'Medium ($10K-$100K)' WHEN a < 1e6 THEN 'Large ($100K-$1M)' ELSE 'Mega (>$1M)' END"
)
SQL = {
    "amount_bands": f"""
SELECT source_row, CAST(a AS DOUBLE) AS amount, CAST(coalesce(a, 0) AS DOUBLE) AS amount_or_zero, {_BAND} AS band,
       CASE WHEN a >= 0 THEN {_BAND} END AS strict_band
FROM (SELECT source_row, {_AMOUNT} AS a FROM {S.PO_SQL} p)""",
    "keyword_classes": f"""
SELECT p_partkey, {keyword_case(_PART_TEXT, _PART_RULES)} AS class, {keyword_case(_PART_TEXT, _PART_RULES, 'LIKE')} AS cased_class,
       contains(p_type, 'ECONOMY') OR contains(p_type, 'STANDARD') AS is_basic FROM part""",
    "phone_classes": f"""
SELECT source_row, digits, regexp_replace("Phone", '[^0-9]', '') AS first_dropped,
       CASE WHEN length(digits) = 10 THEN 'Standard' WHEN length(digits) = 11 AND digits LIKE '1%' THEN 'Standard with 1'
            WHEN length(digits) > 10 AND "Phone" ILIKE '%ext%' THEN 'With Extension'
            WHEN length(digits) < 10 THEN 'Incomplete' ELSE 'Non-standard' END AS phone_type,
       upper(trim(regexp_replace("Vendor Name", '[^A-Za-z0-9 ]', '', 'g'))) AS clean_name
FROM (SELECT *, regexp_replace("Phone", '[^0-9]', '', 'g') AS digits FROM {S.VENDORS_SQL} v)""",
    "fiscal_calendar": f"""
SELECT CAST(day AS VARCHAR) AS day, count(*) AS orders, {fy('day')}::BIGINT AS fiscal_year, {fq('day')}::BIGINT AS fiscal_quarter,
       year(day) AS year, quarter(day) AS quarter, month(day) AS month, strftime(day, '%Y') AS year_text, strftime(day, '%m') AS month_text
FROM (SELECT {DAY_SQL} AS day FROM orders) GROUP BY day""",
    "business_hours": """
SELECT dayofweek(ts) AS dow, dayname(ts) AS day_name, hour(ts) AS hour,
       dayofweek(ts) NOT IN (0, 6) AND hour(ts) >= 8 AND hour(ts) < 17 AS business_hours, count(*) AS events
FROM events GROUP BY ALL""",
    "date_arithmetic": """
SELECT CAST(a AS VARCHAR) AS "start", CAST(b AS VARCHAR) AS "end", CAST(s AS DOUBLE) AS spent, CAST(b - a AS BIGINT) AS days,
       date_diff('month', a, b) AS months, date_diff('year', a, b) AS years, CAST(b + 30 AS VARCHAR) AS end_plus_30,
       CAST(least(t, b) - a AS BIGINT) AS elapsed, CAST(CAST(CAST(s AS DOUBLE) / nullif(least(t, b) - a, 0) AS DECIMAL(18,2)) AS DOUBLE) AS rate,
       CASE WHEN t < a THEN 'Future' WHEN t > b THEN 'Expired' ELSE 'Active' END AS state
FROM (SELECT CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b, DATE '1998-06-30' AS t,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""",
    "row_hash": """
SELECT c_custkey, md5(concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) AS row_hash,
       md5(CAST(c_custkey AS VARCHAR)) AS key_hash, sha256(c_name) AS name_sha256 FROM customer""",
    "change_detection": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, arg_min(h, (l_shipdate, h)) AS first_hash,
       arg_max(h, (l_shipdate, h)) AS last_hash, count(*) AS versions
FROM (SELECT *, md5(concat_ws('|', l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)) AS h FROM lineitem)
GROUP BY 1, 2 HAVING arg_min(h, (l_shipdate, h)) <> arg_max(h, (l_shipdate, h))""",
    "url_build": f"""
SELECT source_row, {_PO_LINK.format(x='"PO #"')} AS po_url, {_PO_LINK.format(x="""split_part("PO #", ':', 1)""")} AS contract_url,
       CASE WHEN source_row % 2 = 0 AND "PO #" IS NOT NULL THEN {_BID} END AS holder_list_url,
       coalesce(length("PO #") > 0, false) AS valid_po,
       coalesce(regexp_matches("PO #", '^([0-9][0-9])?[A-Z]+-([A-Z][A-Z][0-9]+|NV[0-9][0-9]-[0-9]+)$'), false) AS valid_contract
FROM {S.PO_SQL} p""",
    "vendor_ids": f"""
SELECT source_row, 'https://portal.example/bso/external/vendor/vendorProfileOrgInfo.sda?external=true&vendorId=' || "Vendor ID" AS url,
       coalesce(regexp_full_match("Vendor ID", 'VEN[0-9]+'), false) AS valid FROM {S.VENDORS_SQL} v
UNION ALL
SELECT source_row, 'https://portal.example/bso/external/bidDetail.sdo?docId=' || nullif("Bid Solicitation #", '') || '&external=true&parentUrl=close',
       coalesce(regexp_full_match("Bid Solicitation #", '([0-9][0-9])?[A-Z]+-S[0-9]+'), false) FROM {S.BIDS_SQL} b""",
    "path_parts": """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '2024-02-02' ELSE strftime(ts, '%Y-%m-%d') END AS file_date,
       CASE WHEN event_id % 7 = 0 THEN 'unknown' ELSE CAST(user_id AS VARCHAR) END AS run_id, event_type || '.csv' AS file_name
FROM events""",
    "json_props": """
SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, CAST(props ->> '$.k' AS BIGINT) > 50 AS is_high FROM events""",
    "blank_values": f"""
SELECT source_row, v AS raw_value, nullif(trim(v), '') AS clean_value,
       CAST(CASE WHEN coalesce(v, '') = '' THEN 0 ELSE len(string_split(v, ',')) END AS BIGINT) AS parts,
       coalesce(v, '') <> '' AS has_text, trim(coalesce(v, '')) = '' AS is_blank,
       CASE WHEN "Status" = 'Awarded' THEN true WHEN "Status" IN ('Sent', 'Open') THEN false END AS is_awarded
FROM (SELECT *, "Awarded Vendor(s)" AS v FROM {S.BIDS_SQL} b) WHERE trim("Bid Solicitation #") <> ''""",
    "date_checks": f"""
SELECT source_row, CAST(day AS VARCHAR) AS day, day IS NOT NULL AS has_valid_date,
       coalesce(day BETWEEN DATE '2018-01-31' AND {TODAY}, false) AS bid_date_ok,
       coalesce(day BETWEEN DATE '2014-01-01' AND {TODAY}, false) AS contract_date_ok,
       coalesce(day <= {TODAY} + INTERVAL 1 YEAR, false) AS po_date_ok, coalesce(day > {TODAY}, false) AS in_future
FROM (SELECT source_row, CAST(try_strptime("Sent Date", '%m/%d/%Y') AS DATE) AS day FROM {S.PO_SQL} p)""",
    "interval_filter": f"""
SELECT source_row, "Contract #" AS contract_id FROM {S.CONTRACTS_SQL} c
WHERE strptime("Begin Date", '%m/%d/%Y') <= strptime("End Date", '%m/%d/%Y') AND trim("Contract #") <> ''
  AND TRY_CAST(translate("Dollars Spent to Date", '$,', '') AS DECIMAL(12,2)) >= 0""",
    "test_rows": f"""
SELECT source_row, contains("Vendor", 'TEST') OR contains("Vendor", 'DEMO') AS cased,
       contains(lower("Vendor"), 'test') OR contains(lower("Vendor"), 'do not use') AS caseless,
       regexp_matches("Vendor", 'TEST|DEMO|DO NOT USE') AS by_pattern FROM {S.PO_SQL} p""",
    "small_numbers": f"""
SELECT source_row, CASE WHEN mark IS NULL THEN k ELSE split_part(k, mark, 1) END AS base_id,
       CASE WHEN mark IS NULL THEN 0 ELSE CAST(TRY_CAST(split_part(k, mark, 2) AS SMALLINT) AS BIGINT) END AS revision,
       CASE WHEN contains(k, ':') THEN CAST(TRY_CAST(split_part(k, ':', 2) AS INTEGER) AS BIGINT) ELSE 0 END AS colon_revision
FROM (SELECT source_row, "PO #" AS k, CASE WHEN contains("PO #", ':') THEN ':' WHEN contains("PO #", '.') THEN '.' END AS mark
      FROM {S.PO_SQL} p)""",
    "range_join": f"""
SELECT range_id, count(*) AS orders, count(DISTINCT o_custkey) AS customers
FROM (SELECT o_custkey, {DAY_SQL} AS day FROM orders)
JOIN (SELECT DISTINCT 'from_' || year({DAY_SQL}) AS range_id, date_trunc('year', {DAY_SQL}) AS s FROM orders) r
  ON day BETWEEN s AND s + INTERVAL 400 DAY
GROUP BY 1""",
}
