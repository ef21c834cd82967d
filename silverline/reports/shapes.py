"""Procurement-shaped views over the given tables.

The tables hold no procurement columns, so each dataset is derived from them row by row. One text
serves both engines; a `Dialect` supplies the few functions that are spelled differently.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.plans.silver.common import SilverRun
from silverline.sources.readers import spread

ASOF = dt.date(2024, 1, 20)
NOW = dt.datetime(2024, 1, 20, 12, 0, 0)
RUN = SilverRun(snapshot_id="snapshot_a", asof=ASOF, processed_at=NOW)


@dataclass(frozen=True)
class Dialect:
    quote: str
    us_date: Callable[[str], str]
    us_time: Callable[[str], str]
    money: Callable[[str], str]
    div: Callable[[str, int], str]
    add_days: Callable[[str, str], str]


SPARK = Dialect(
    quote="`",
    us_date=lambda e: f"date_format({e}, 'MM/dd/yyyy')",
    us_time=lambda e: f"date_format({e}, 'MM/dd/yyyy HH:mm:ss')",
    money=lambda e: f"concat('$', format_number({e}, 2))",
    div=lambda e, n: f"({e} div {n})",
    add_days=lambda e, n: f"date_add(cast({e} as date), cast({n} as int))",
)
DUCKDB = Dialect(
    quote='"',
    us_date=lambda e: f"strftime({e}, '%m/%d/%Y')",
    us_time=lambda e: f"strftime({e}, '%m/%d/%Y %H:%M:%S')",
    money=lambda e: f"('$' || format('{{:,.2f}}', {e}))",
    div=lambda e, n: f"({e} // {n})",
    add_days=lambda e, n: f"(cast({e} as date) + cast({n} as int))",
)


def pick(index: str, values: list[str | None]) -> str:
    """CASE over a small index."""
    whens = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values)
    )
    return f"CASE {index} {whens} END"


VENDOR_NAMES = [
    "Amazon Business", "STAPLES Advantage", "Dell Marketing LP", "Grainger Industrial", "CDW Government",
    "ODP Business Solutions", "Office Depot", "The Home Depot Pro", "PRINCE Consulting LLC", "Acme, Inc.",
    "TEST vendor", "Vendor DO NOT USE", None, "Microsoft Corporation", "Oracle America", "Sierra Building Supply",
]
PARTY_NAMES = [
    "Amazon Web Services, Inc.", "PRINCE", "Acme, LLC", "X CO.", "HP Inc", "Hewlett Packard", "A CO B", "City of Reno",
    "University of Nowhere", "Desert Partnership", "Helping Foundation", "DBA Harry", "Power & Light Corp",
    "Blue Freight Logistics", "Good Food Catering", "Office Supplies Plus", "Medical Health Partners", "IBM",
    "Cisco Systems", "Xerox", "Adobe Software", "DEMO vendor", "Vendor DO NOT USE", "test vendor", " ", None,
    "Contractor's Building Company",
]
PHONES = ["775-555-0100", "1-775-555-0100", "(775) 555-0100 ext 12", "555-0100", None, "+44 20 7946 0958 1", "7755550100"]
STATUSES = [
    "3PS - Sent", "3PCO - Closed", "3PPR - Partial Receipt", "3PCR - Complete Receipt", "3PD - Draft",
    "3PC - Cancelled", "1D - In Draft", "3PPOH - On Hold", None, "3PCA - Cancelled", "Odd",
]


def po_raw(d: Dialect, orders: str, customer: str, nation: str) -> str:
    group = d.div("o_orderkey", 3)
    day = "(o_orderdate + interval 24 year)"
    return f"""
select case when g % 211 = 0 then null
            when g % 223 = 0 then 'IGOR ' || cast(g as string)
            when g % 199 = 0 then 'TEST-' || cast(g as string)
            else lpad(cast(g % 100 as string), 2, '0') || {pick("g % 4", ["DOA", "SWC", "DOE", "DHHS"])}
                 || '-NV' || cast(18 + g % 8 as string) || '-' || cast(g as string)
                 || case when g % 10 = 0 then ':' || cast(g % 7 as string)
                         when g % 10 = 1 then '.' || cast(g % 5 as string)
                         when g % 50 = 2 then ':abc' when g % 50 = 3 then ':1.7'
                         when g % 50 = 4 then ':40000' else '' end end as "PO #",
       {pick("k % 5", ["G2B office order", " chairs ", "G2B", "desks", None])} as "Description",
       {pick("(k + c) % 16", VENDOR_NAMES)} as "Vendor",
       case when nk % 5 = 0 then 'Statewide Contracts' when nk = 7 then null else nation_name end as "Organization",
       segment as "Department", buyer as "Buyer",
       {pick("k % 11", STATUSES)} as "Status",
       case when k % 101 = 0 then null when k % 103 = 0 then '13/45/2020' else {d.us_date("day")} end as "Sent Date",
       case when k % 97 = 0 then '$.00' when k % 89 = 0 then null when k % 83 = 0 then 'abc'
            when k % 79 = 0 then '-12.50' else {d.money("price")} end as "Total",
       'export' as source_system, 'po_' || cast(k % 4 as string) || '.csv' as source_file,
       md5('po_' || cast(k % 4 as string)) as source_file_hash, cast(1000 + k % 4 as bigint) as source_file_bytes,
       cast(k as bigint) as source_row, ingested_at, 'run_a' as bronze_run_id, md5(cast(k as string)) as row_hash
from (select {group} as g, o_orderkey as k, o_custkey as c, c_nationkey as nk, n_name as nation_name,
             c_mktsegment as segment, c_name as buyer, {day} as day, o_orderdate as ingested_at, o_totalprice as price
      from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey) t
"""


def contracts_raw(d: Dialect, orders: str, customer: str, nation: str) -> str:
    day = "(o_orderdate + interval 24 year)"
    end = d.add_days("day", "((k * 37) % 1500 - 50)")
    return f"""
select case when c % 97 = 0 then null when c % 89 = 0 then 'TEST-MC' || cast(c as string)
            when c % 2 = 0 then lpad(cast(c % 100 as string), 2, '0') || 'DOT-MC' || cast(c as string)
            else 'BRDCOM-NV23-' || cast(c as string) end as "Contract #",
       cast(null as string) as "Bid Solicitation #",
       {pick("k % 4", ["road work", "Testing lab", "G2B", None])} as "Description",
       {pick("(k + c) % 16", VENDOR_NAMES)} as "Vendor", cast(null as string) as "Type Code",
       case when k % 89 = 0 then null when k % 97 = 0 then '$.00' when k % 79 = 0 then '-1.00'
            else {d.money("price")} end as "Dollars Spent to Date",
       case when nk % 5 = 0 then 'Statewide Contracts' when nk = 7 then null else nation_name end as "Organization",
       {pick("k % 5", ["3PS - Sent", "Active", "Expired", "3PCO - Closed", None])} as "Status",
       case when k % 101 = 0 then null else {d.us_date("day")} end as "Begin Date",
       case when k % 103 = 0 then null else {d.us_date(end)} end as "End Date",
       'export' as source_system, 'contracts.csv' as source_file, md5('contracts') as source_file_hash,
       cast(2000 as bigint) as source_file_bytes, cast(k as bigint) as source_row, ingested_at,
       'run_b' as bronze_run_id, md5(cast(k as string)) as row_hash
from (select o_orderkey as k, o_custkey as c, c_nationkey as nk, n_name as nation_name, {day} as day,
             o_orderdate as ingested_at, o_totalprice as price
      from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey) t
"""


def vendors_raw(d: Dialect, customer: str, supplier: str) -> str:
    return f"""
select case when g % 97 = 0 then null when g % 89 = 0 then 'TEST' || cast(g as string)
            else 'VEN' || cast(g as string) end as "Vendor ID",
       {pick("(k * 5 + g) % 27", PARTY_NAMES)} as "Vendor Name",
       {pick("k % 3", ["1 Main St", None, None])} as "Address", {pick("k % 2", ["Reno", None])} as "City",
       {pick("k % 5", ["NV", "Nevada", "CA", None, None])} as "State",
       {pick("k % 4", ["89501", "89501-1234", "NV 89501", None])} as "Postal Code",
       party as "Contact Name", {pick("k % 7", PHONES)} as "Phone",
       'export' as source_system, 'vendors.csv' as source_file, md5('vendors') as source_file_hash,
       cast(3000 as bigint) as source_file_bytes, cast(k as bigint) as source_row,
       timestamp '2024-01-01 00:00:00' as ingested_at, 'run_c' as bronze_run_id, md5(cast(k as string)) as row_hash
from (select c_custkey as k, {d.div("c_custkey", 2)} as g, c_name as party from {customer}
      union all
      select 1000000000 + s_suppkey as k, s_suppkey as g, s_name as party from {supplier}) t
"""


def bids_raw(d: Dialect, events: str) -> str:
    group = d.div("event_id", 3)
    return f"""
select case when g % 211 = 0 then null when g % 199 = 0 then '' when g % 197 = 0 then 'TEST-S' || cast(g as string)
            else lpad(cast(g % 100 as string), 2, '0') || {pick("g % 3", ["DOE", "DPS", "VS"])}
                 || '-S' || cast(g as string) end as "Bid Solicitation #",
       {pick("k % 4", ["Statewide Contracts", "Department of Energy", None, "Parks"])} as "Organization Name",
       {pick("k % 3", ["80DOT-MC3960", "", None])} as "Contract #", 'user ' || cast(u as string) as "Buyer",
       {pick("k % 5", ["Bridge repair", "testing kits", "Demo day", "Paint", None])} as "Description",
       case when k % 101 = 0 then null when k % 103 = 0 then '' else {d.us_time("ts")} end as "Bid Opening Date",
       {pick("k % 3", ["/bso/external/bidAckList.sdo", None, "View List"])} as "Bid Holder List",
       {pick("k % 6", [None, "", "A", "A,B,C", "A,B,", " "])} as "Awarded Vendor(s)",
       {pick("k % 9", ["Approved", "Bid to PO", "Closed", "Evaluated", "Opened", "Sent", "Awarded", "Open", None])} as "Status",
       {pick("k % 4", ["ALT-1", " ALT-2 ", " ", None])} as "Alternate Id",
       'export' as source_system, 'bids.csv' as source_file, md5('bids') as source_file_hash,
       cast(4000 as bigint) as source_file_bytes, cast(k as bigint) as source_row, ts as ingested_at,
       'run_d' as bronze_run_id, md5(cast(k as string)) as row_hash
from (select {group} as g, event_id as k, user_id as u, ts from {events}) t
"""


def duck(shape: Callable[..., str], *tables: str) -> str:
    return "(" + shape(DUCKDB, *tables) + ")"


PO_SQL = duck(po_raw, "orders", "customer", "nation")
CONTRACTS_SQL = duck(contracts_raw, "orders", "customer", "nation")
VENDORS_SQL = duck(vendors_raw, "customer", "supplier")
BIDS_SQL = duck(bids_raw, "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name == "lineitem" else rows


def _spark(spark: SparkSession, sf_dir: str, shape: Callable[..., str], *tables: str) -> DataFrame:
    text = shape(SPARK, *[f"{{{name}}}" for name in tables]).replace('"', "`")
    frames = {name: table(spark, sf_dir, name) for name in tables}
    # The first table is the large one; deriving text from it is the costly part.
    frames[tables[0]] = spread(frames[tables[0]])
    return spark.sql(text, **frames)


def purchase_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, po_raw, "orders", "customer", "nation")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, contracts_raw, "orders", "customer", "nation")


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, vendors_raw, "customer", "supplier")


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, bids_raw, "events")


def flat(df: DataFrame, *drop: str) -> DataFrame:
    """Columns in the plain types both engines report alike: text, long, double, boolean."""
    columns = []
    for field in df.schema:
        if field.name in drop:
            continue
        value, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind == "date":
            value = F.date_format(value, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("decimal", "float"):
            value = value.cast("double")
        elif kind in ("byte", "short", "integer"):
            value = value.cast("long")
        columns.append(value.alias(field.name))
    return df.select(*columns)
