"""The silver transforms over procurement-shaped views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverline.functions import rules
from silverline.functions.links import DEFAULT_HOST, HOLDER_LIST_PATH
from silverline.plans.silver import find
from silverline.reports import shapes as S

Query = Callable[[SparkSession, str], DataFrame]

TODAY = f"DATE '{S.ASOF.isoformat()}'"
NOW = f"TIMESTAMP '{S.NOW.isoformat(sep=' ')}'"
FLOOR_DAY = f"DATE '{rules.FIRST_DAY_OF_DATA}'"


def text_list(values: list[str]) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def keyword_case(column: str, table: rules.Rules, operator: str = "ILIKE") -> str:
    """A CASE over a rule table, first match first."""
    branches = []
    for label, words in table:
        tests = [f"{column} {operator} '{word if '%' in word else '%' + word + '%'}'" for word in words]
        branches.append(f"WHEN {' OR '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(branches)} ELSE 'Other' END"


def names_case(column: str, names: dict[str, str], otherwise: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE {otherwise} END"


def groups_case(column: str, groups: dict[str, list[str]]) -> str:
    branches = " ".join(f"WHEN {column} IN ({text_list(v)}) THEN '{k}'" for k, v in groups.items())
    return f"CASE {branches} ELSE 'Unknown' END"


BAND_CASE = (
    "CASE WHEN amount = 0 THEN 'Zero' "
    + " ".join(f"WHEN amount < {upper} THEN '{label}'" for upper, label in rules.AMOUNT_BANDS)
    + f" ELSE '{rules.AMOUNT_TOP}' END"
)


def fy(day: str) -> str:
    return f"(year({day}) + CASE WHEN month({day}) > 6 THEN 1 ELSE 0 END)"


def fq(day: str) -> str:
    return f"(((month({day}) + 5) % 12) // 3 + 1)"


def newest(source: str, key: str) -> str:
    return (
        f"(SELECT * FROM {source} QUALIFY row_number() OVER "
        f'(PARTITION BY "{key}" ORDER BY ingested_at DESC NULLS LAST, source_row DESC NULLS LAST, '
        "source_file DESC NULLS LAST, source_file_hash DESC NULLS LAST, row_hash DESC NULLS LAST) = 1)"
    )


def _po_base(source: str, precision: int) -> str:
    """Purchase orders with the parsed day, amount and id parts."""
    return f"""(
SELECT *, CAST(try_strptime("Sent Date", '%m/%d/%Y') AS DATE) AS day,
       TRY_CAST(translate("Total", '$,', '') AS DECIMAL({precision},2)) AS amount,
       CASE WHEN contains("PO #", ':') THEN ':' WHEN contains("PO #", '.') THEN '.' END AS mark
FROM {source})"""


_PO_PARTS = """
       CASE WHEN mark IS NULL THEN "PO #" ELSE split_part("PO #", mark, 1) END AS base_po_id,
       CASE WHEN mark IS NULL THEN 0 ELSE CAST(TRY_CAST(split_part("PO #", mark, 2) AS SMALLINT) AS BIGINT) END
         AS revision_number"""
_PO_CALENDAR = f"""
       {fy('day')}::BIGINT AS fiscal_year, {fq('day')}::BIGINT AS fiscal_quarter,
       year(day)::BIGINT AS calendar_year, month(day)::BIGINT AS calendar_month,
       quarter(day)::BIGINT AS calendar_quarter"""
_LINEAGE = "source_file_hash AS source_hash, row_hash, strftime({t}, '%Y-%m-%d %H:%M:%S') AS bronze_ingested_at"
_INGESTED = "strftime(ingested_at, '%Y-%m-%d %H:%M:%S')"


def _stamp(version: str) -> str:
    return f"'{version}' AS transform_version, '{S.RUN.snapshot_id}' AS snapshot_id"


def named(dataset: str) -> str:
    return f"{dataset}_v0.1.0.sql"


def _lineage(version: str) -> str:
    return _LINEAGE.format(t="ingested_at") + ", " + _stamp(version)


def _po_v010() -> str:
    trimmed = ", ".join(f'trim("{n}") AS {n.lower()}' for n in ("Description", "Vendor", "Organization", "Department", "Buyer"))
    return f"""
SELECT trim("PO #") AS po_id,
       CASE WHEN contains("PO #", ':') THEN CAST(TRY_CAST(split_part("PO #", ':', 2) AS INTEGER) AS BIGINT) ELSE 0 END AS revision_number,
       split_part("PO #", ':', 1) AS base_po_id, "Sent Date" AS sent_date_raw, CAST(day AS VARCHAR) AS sent_date,
       "Status" AS status_code, {names_case('"Status"', rules.PO_STATUS_NAMES_FULL, """split_part("Status", ' - ', 2)""")} AS status,
       {groups_case('"Status"', rules.PO_STATUS_GROUPS_FULL)} AS status_category, {trimmed},
       "Total" AS total_raw, CAST(amount AS DOUBLE) AS total_amount,
       {fy('day')}::BIGINT AS fiscal_year, quarter(day)::BIGINT AS calendar_quarter, {fq('day')}::BIGINT AS fiscal_quarter,
       year(day)::BIGINT AS sent_year, month(day)::BIGINT AS sent_month,
       coalesce(amount = 0, false) AS is_zero_dollar,
       coalesce("Organization" = 'Statewide Contracts', false) AS is_statewide_contract,
       {_INGESTED} AS first_seen_at, {_INGESTED} AS last_seen_at, CAST(1 AS BIGINT) AS version_count,
       source_system, source_file, source_file_hash, row_hash AS bronze_row_hash, {_stamp('v0.1.0')}
FROM {_po_base(newest(S.PO_SQL, 'PO #'), 18)} p
WHERE trim("PO #") <> '' AND day BETWEEN {FLOOR_DAY} AND {TODAY} + 30 AND coalesce(amount, 0) >= 0
  AND NOT regexp_matches("PO #", 'TEST|DEMO|TEMP')"""


def _po_v020() -> str:
    def dim(column: str, key: str) -> str:
        return f'(SELECT "{column}" AS v_{key}, row_number() OVER (ORDER BY "{column}") AS {key} FROM (SELECT DISTINCT "{column}" FROM newest))'

    return f"""
WITH newest AS (SELECT * FROM {_po_base(newest(S.PO_SQL, 'PO #'), 12)} b)
SELECT trim("PO #") AS po_id, {_PO_PARTS}, CAST(day AS VARCHAR) AS sent_date,
       coalesce(CAST(amount AS DOUBLE), 0) AS total_amount, trim("Description") AS description,
       trim("Vendor") AS vendor_name, trim("Buyer") AS buyer_name, organization_id, department_id, status_id,
       "Organization" AS organization, "Department" AS department,
       {names_case('"Status"', rules.PO_STATUS_NAMES, """split_part("Status", ' - ', 2)""")} AS status,
       {groups_case('"Status"', rules.PO_STATUS_GROUPS)} AS status_category, {_PO_CALENDAR},
       coalesce(amount = 0, false) AS is_zero_dollar,
       coalesce("Organization" = 'Statewide Contracts', false) AS is_statewide_contract,
       coalesce(starts_with("Description", 'G2B'), false) AS is_g2b_purchase,
       {keyword_case('"Vendor"', rules.PO_VENDOR_CASED, 'LIKE')} AS vendor_category,
       {_INGESTED} AS first_seen_at, {_INGESTED} AS last_seen_at, CAST(1 AS BIGINT) AS version_count,
       source_file_hash AS source_hash, row_hash, {_stamp('v0.2.0')}
FROM newest JOIN {dim('Organization', 'organization_id')} o ON v_organization_id = "Organization"
     JOIN {dim('Department', 'department_id')} d ON v_department_id = "Department"
     JOIN {dim('Status', 'status_id')} s ON v_status_id = "Status"
WHERE "PO #" IS NOT NULL AND day BETWEEN {FLOOR_DAY} AND {TODAY} + 30 AND coalesce(amount, 0) >= 0
  AND NOT regexp_matches("PO #", 'TEST|DEMO|TEMP|SAMPLE') AND NOT regexp_matches("Vendor", 'TEST|DEMO|DO NOT USE')"""


def _po_typed(version: str, where: str) -> str:
    return f"""
SELECT "PO #" AS po_id, {_PO_PARTS}, CAST(day AS VARCHAR) AS sent_date, CAST(amount AS DOUBLE) AS total_amount,
       "Description" AS description, "Vendor" AS vendor_name, "Organization" AS organization,
       "Department" AS department, "Buyer" AS buyer_name, "Status" AS status_code,
       {names_case('"Status"', rules.PO_STATUS_NAMES, """split_part("Status", ' - ', 2)""")} AS status_name,
       {groups_case('"Status"', rules.PO_STATUS_GROUPS)} AS status_category, {_PO_CALENDAR},
       amount = 0 AS is_zero_dollar, "Organization" = 'Statewide Contracts' AS is_statewide_contract,
       starts_with("Description", 'G2B') AS is_g2b_purchase,
       {keyword_case('"Vendor"', rules.PO_VENDOR)} AS vendor_category, {BAND_CASE} AS amount_category, {_lineage(version)}
FROM {_po_base(newest(S.PO_SQL, 'PO #'), 15)} p WHERE "PO #" IS NOT NULL {where}"""


def _po_v050() -> str:
    return f"""
SELECT "PO #" AS po_id, {_PO_PARTS}, CAST(day AS VARCHAR) AS sent_date, CAST(amount AS DOUBLE) AS total_amount,
       "Description" AS description, "Vendor" AS vendor_name, "Organization" AS organization,
       "Department" AS department, "Buyer" AS buyer_name, "Status" AS status,
       year(day)::BIGINT AS fiscal_year, quarter(day)::BIGINT AS fiscal_quarter, month(day)::BIGINT AS fiscal_month,
       nullif(regexp_extract("PO #", '^([^-]*)-', 1), '') AS org_code,
       CASE WHEN contains("PO #", '-NV') THEN CAST(TRY_CAST('20' || left(split_part("PO #", '-NV', 2), 2) AS SMALLINT) AS BIGINT) END AS po_fiscal_year,
       {keyword_case('"Status"', rules.PO_STATUS_CLASS, 'LIKE')} AS status_category,
       amount IS NOT NULL AS has_valid_amount, day IS NOT NULL AS has_valid_date,
       row_number() OVER (PARTITION BY "PO #" ORDER BY source_row, source_file_hash, row_hash) AS instance_number,
       count(*) OVER (PARTITION BY "PO #") AS total_instances,
       source_system, source_file, source_file_hash, source_file_bytes, source_row, {_INGESTED} AS ingested_at,
       bronze_run_id, row_hash, 'v0.5.0' AS silver_version
FROM {_po_base(S.PO_SQL, 15)} p"""


def _bids_v010() -> str:
    listed = f"\"Bid Holder List\" = '{HOLDER_LIST_PATH}'"
    clean = ", ".join(
        f"\"{n}\" AS {a}_raw, nullif(trim(\"{n}\"), '') AS {a}"
        for n, a in (("Contract #", "contract_id"), ("Awarded Vendor(s)", "awarded_vendors"), ("Alternate Id", "alternate_id"))
    )
    return f"""
SELECT "Bid Solicitation #" AS bid_id, "Organization Name" AS organization, "Buyer" AS buyer, "Description" AS description,
       "Status" AS status, {clean}, "Bid Opening Date" AS bid_opening_date_raw,
       strftime(opening, '%Y-%m-%d %H:%M:%S') AS bid_opening_date, "Bid Holder List" AS bid_holder_list_raw,
       {listed} AS has_holder_list,
       CASE WHEN {listed} THEN 'https://{DEFAULT_HOST}{HOLDER_LIST_PATH}?bidId=' || "Bid Solicitation #" END AS bid_holder_list_url,
       CASE WHEN {listed} THEN '{DEFAULT_HOST}' END AS bid_holder_list_url_host,
       CASE WHEN {listed} THEN '{HOLDER_LIST_PATH}' END AS bid_holder_list_url_path,
       CASE WHEN "Status" = 'Awarded' THEN true WHEN "Status" IN ('Sent', 'Open') THEN false END AS is_awarded,
       source_system, source_file, source_row, {_INGESTED} AS ingested_at, row_hash AS bronze_row_hash,
       '{named("bids")}' AS transform_sql, {_stamp('v0.1.0')}
FROM (SELECT *, try_strptime("Bid Opening Date", '%m/%d/%Y %H:%M:%S') AS opening FROM {S.BIDS_SQL} r) b
WHERE "Bid Solicitation #" <> '' AND (opening IS NULL OR opening BETWEEN {FLOOR_DAY} AND {TODAY} + INTERVAL 365 DAY)"""


def _bids_typed(version: str, where: str) -> str:
    group = groups_case('"Status"', rules.BID_STATUS_GROUPS)
    return f"""
SELECT "Bid Solicitation #" AS bid_solicitation_id, "Contract #" AS contract_id, "Alternate Id" AS alternate_id,
       "Description" AS description, "Organization Name" AS organization, "Buyer" AS buyer_name,
       strftime(opening, '%Y-%m-%d %H:%M:%S') AS bid_opening_timestamp, strftime(opening, '%Y-%m-%d') AS bid_opening_date,
       hour(opening) AS bid_opening_hour, minute(opening) AS bid_opening_minute, dayofweek(opening) AS bid_opening_dow,
       dayname(opening) AS bid_opening_day_name,
       dayofweek(opening) BETWEEN 1 AND 5 AND hour(opening) BETWEEN 8 AND 16 AS is_business_hours,
       "Status" AS status_code, {names_case('"Status"', rules.BID_STATUS_NAMES, '"Status"')} AS status_name,
       {group} AS status_category, "Bid Holder List" AS bid_holder_list, "Bid Holder List" IS NOT NULL AS has_bid_holder_list,
       "Awarded Vendor(s)" AS awarded_vendors, coalesce(length("Awarded Vendor(s)"), 0) > 0 AS has_awarded_vendor,
       CASE WHEN coalesce("Awarded Vendor(s)", '') = '' THEN 0 ELSE len(string_split("Awarded Vendor(s)", ',')) END AS awarded_vendor_count,
       CASE WHEN opening > {NOW} THEN 'Future' ELSE {group} END AS bid_status,
       date_diff('day', CAST(opening AS DATE), {TODAY}) AS days_since_opening,
       {fy('opening')}::BIGINT AS fiscal_year, {fq('opening')}::BIGINT AS fiscal_quarter,
       coalesce(length("Contract #"), 0) > 0 AS has_contract, "Organization Name" = 'Statewide Contracts' AS is_statewide,
       "Status" = 'Bid to PO' AS is_converted_to_po, {_lineage(version)}
FROM (SELECT *, try_strptime("Bid Opening Date", '%m/%d/%Y %H:%M:%S') AS opening
      FROM {newest(S.BIDS_SQL, 'Bid Solicitation #')} r) b
WHERE "Bid Solicitation #" IS NOT NULL {where}"""


_CONTRACT_DAYS = """CAST(try_strptime("Begin Date", '%m/%d/%Y') AS DATE) AS b, CAST(try_strptime("End Date", '%m/%d/%Y') AS DATE) AS e"""
_SPENT = "TRY_CAST(translate(\"Dollars Spent to Date\", '$,', '') AS DECIMAL({p},2)) AS spent"


def _contracts_v010() -> str:
    return f"""
SELECT "Contract #" AS contract_id, "Bid Solicitation #" AS bid_solicitation_id, "Description" AS description,
       "Vendor" AS vendor, "Type Code" AS type_code, "Organization" AS organization, "Status" AS status,
       "Dollars Spent to Date" AS dollars_spent_raw, CAST(spent AS DOUBLE) AS dollars_spent,
       "Begin Date" AS begin_date_raw, CAST(b AS VARCHAR) AS begin_date, "End Date" AS end_date_raw,
       CAST(e AS VARCHAR) AS end_date,
       CASE WHEN "Status" IN ('Active', 'Current', 'Open') THEN true
            WHEN "Status" IN ('Expired', 'Terminated', 'Cancelled', 'Closed') THEN false END AS is_active,
       CAST(e - b AS BIGINT) AS contract_duration_days, source_system, source_file, source_file_hash, source_row,
       {_INGESTED} AS ingested_at, bronze_run_id, row_hash AS bronze_row_hash,
       '{named("contracts")}' AS transform_sql, {_stamp('v0.1.0')}
FROM (SELECT *, {_CONTRACT_DAYS}, {_SPENT.format(p=18)} FROM {S.CONTRACTS_SQL} r) c
WHERE "Contract #" <> '' AND coalesce(b, DATE '2001-01-01') BETWEEN DATE '2000-01-01' AND {TODAY} + 365
  AND coalesce(e, DATE '2001-01-01') >= DATE '2000-01-01' AND coalesce(spent, 0) >= 0
  AND NOT regexp_matches("Contract #", 'TEST|DEMO')"""


def _contracts_typed(version: str, where: str) -> str:
    days = f"nullif(least({TODAY}, e) - b, 0)"
    return f"""
SELECT "Contract #" AS contract_id, "Bid Solicitation #" AS bid_solicitation_id, "Type Code" AS type_code,
       "Description" AS description, "Vendor" AS vendor_name, "Organization" AS organization,
       CAST(spent AS DOUBLE) AS dollars_spent_to_date, CAST(b AS VARCHAR) AS begin_date, CAST(e AS VARCHAR) AS end_date,
       CAST(e - b AS BIGINT) AS contract_duration_days, date_diff('month', b, e) AS contract_duration_months,
       "Status" AS status_code, split_part("Status", ' - ', 2) AS status_name,
       CASE WHEN {TODAY} < b THEN 'Future' WHEN {TODAY} > e THEN 'Expired' ELSE 'Active' END AS contract_status,
       CAST(e - {TODAY} AS BIGINT) AS days_until_expiration,
       {fy('b')}::BIGINT AS fiscal_year_begin, {fy('e')}::BIGINT AS fiscal_year_end, spent = 0 AS is_zero_spend,
       "Organization" = 'Statewide Contracts' AS is_statewide_contract, date_diff('year', b, e) > 1 AS is_multi_year,
       CASE WHEN {TODAY} > b THEN CAST(CAST(CAST(spent AS DOUBLE) / {days} AS DECIMAL(12,2)) AS DOUBLE) END AS daily_spend_rate,
       {keyword_case('"Vendor"', rules.CONTRACT_VENDOR)} AS vendor_category, {_lineage(version)}
FROM (SELECT *, {_CONTRACT_DAYS}, {_SPENT.format(p=12)} FROM {newest(S.CONTRACTS_SQL, 'Contract #')} r) c
WHERE "Contract #" IS NOT NULL {where}"""


_VENDOR_PLAIN = """"Vendor ID" AS vendor_id, "Vendor Name" AS vendor_name, "Address" AS address, "City" AS city, "State" AS state,
       "Postal Code" AS postal_code, "Contact Name" AS contact_name, "Phone" AS phone"""


def _vendors_v010() -> str:
    return f"""
SELECT {_VENDOR_PLAIN}, coalesce("State" IN ('NV', 'Nevada'), false) AS is_nevada_vendor,
       regexp_replace("Phone", '[^0-9]', '') AS phone_digits_only,
       left(regexp_replace("Postal Code", '[^0-9]', ''), 5) AS zip5,
       source_system, source_file, source_file_hash, source_row, {_INGESTED} AS ingested_at, bronze_run_id,
       row_hash AS bronze_row_hash, '{named("vendors")}' AS transform_sql, {_stamp('v0.1.0')}
FROM {S.VENDORS_SQL} v
WHERE "Vendor ID" <> '' AND "Vendor Name" <> '' AND NOT regexp_matches("Vendor Name", 'TEST|DEMO|DO NOT USE')"""


def _vendors_typed(version: str, where: str) -> str:
    name = '"Vendor Name"'
    return f"""
SELECT {_VENDOR_PLAIN}, upper(trim(regexp_replace({name}, '[^A-Za-z0-9 ]', '', 'g'))) AS vendor_name_clean, phone_digits,
       CASE WHEN length(phone_digits) = 10 THEN 'Standard'
            WHEN length(phone_digits) = 11 AND phone_digits[1] = '1' THEN 'Standard with 1'
            WHEN length(phone_digits) > 10 AND lower("Phone") LIKE '%ext%' THEN 'With Extension'
            WHEN length(phone_digits) < 10 THEN 'Incomplete' ELSE 'Non-standard' END AS phone_type,
       {keyword_case(name, rules.VENDOR_TYPE)} AS vendor_type, {keyword_case(name, rules.VENDOR_BRAND)} AS vendor_category,
       {keyword_case(name, rules.VENDOR_INDUSTRY)} AS industry_category,
       coalesce("Address", "City", "State") IS NULL AS is_missing_address,
       length(phone_digits) <> 10 AS is_non_standard_phone, {_lineage(version)}
FROM (SELECT *, regexp_replace("Phone", '[^0-9]', '', 'g') AS phone_digits
      FROM {newest(S.VENDORS_SQL, 'Vendor ID')} r) v
WHERE "Vendor ID" IS NOT NULL {where}"""


def _run(dataset: str, version: str, variant: str | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = getattr(S, dataset)(spark, sf_dir)
        return S.flat(find(dataset, version, variant)(rows, S.RUN), "transformed_at", "silver_processed_at")

    return query


_PO_STRICT = (
    f"AND day BETWEEN {FLOOR_DAY} AND {TODAY} + 30 AND amount >= 0 AND NOT regexp_matches(lower(\"PO #\"), 'test|demo') "
    "AND NOT regexp_matches(lower(\"Vendor\"), 'test|do not use')"
)
_BIDS_STRICT = (
    f"AND opening BETWEEN {FLOOR_DAY} AND {NOW} + INTERVAL 365 DAY AND NOT lower(\"Bid Solicitation #\") LIKE '%test%' "
    "AND NOT regexp_matches(lower(\"Description\"), 'test|demo')"
)
_CONTRACTS_STRICT = (
    f"AND b <= e AND b >= {FLOOR_DAY} AND e <= DATE '2050-12-31' AND spent >= 0 "
    "AND NOT lower(\"Contract #\") LIKE '%test%' AND NOT regexp_matches(lower(\"Vendor\"), 'test|do not use')"
)
_VENDORS_STRICT = (
    "AND trim(\"Vendor Name\") <> '' AND NOT regexp_matches(lower(\"Vendor Name\"), 'test|demo|do not use') "
    "AND NOT lower(\"Vendor ID\") LIKE '%test%'"
)

QUERIES: dict[str, Query] = {
    "po_v010": _run("purchase_orders", "v0.1.0"),
    "po_opt_v020": _run("purchase_orders", "v0.2.0", "optimized"),
    "po_v030": _run("purchase_orders", "v0.3.0"),
    "po_v040": _run("purchase_orders", "v0.4.0"),
    "po_v050": _run("purchase_orders", "v0.5.0"),
    "bids_v010": _run("bids", "v0.1.0"),
    "bids_v020": _run("bids", "v0.2.0"),
    "bids_v030": _run("bids", "v0.3.0"),
    "contracts_v010": _run("contracts", "v0.1.0"),
    "contracts_v020": _run("contracts", "v0.2.0"),
    "contracts_v030": _run("contracts", "v0.3.0"),
    "vendors_v010": _run("vendors", "v0.1.0"),
    "vendors_v020": _run("vendors", "v0.2.0"),
    "vendors_v030": _run("vendors", "v0.3.0"),
}
SQL: dict[str, str] = {
    "po_v010": _po_v010(),
    "po_opt_v020": _po_v020(),
    "po_v030": _po_typed("v0.3.0", _PO_STRICT),
    "po_v040": _po_typed("v0.4.0", ""),
    "po_v050": _po_v050(),
    "bids_v010": _bids_v010(),
    "bids_v020": _bids_typed("v0.2.0", _BIDS_STRICT),
    "bids_v030": _bids_typed("v0.3.0", ""),
    "contracts_v010": _contracts_v010(),
    "contracts_v020": _contracts_typed("v0.2.0", _CONTRACTS_STRICT),
    "contracts_v030": _contracts_typed("v0.3.0", ""),
    "vendors_v010": _vendors_v010(),
    "vendors_v020": _vendors_typed("v0.2.0", _VENDORS_STRICT),
    "vendors_v030": _vendors_typed("v0.3.0", ""),
}
