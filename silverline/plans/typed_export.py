"""Typed Parquet straight from exports, by a column map."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions import dates, numbers, text
from silverline.functions.links import HOLDER_LIST_PATH
from silverline.sources.writers import write_typed, write_year_month

PARSERS: dict[str, Callable[[Column], Column]] = {
    "date": dates.parse_date,
    "time": dates.parse_timestamp,
    "money": lambda c: numbers.money(c, 18),
    "integer": lambda c: numbers.whole_number(c, "int"),
    "empty_to_null": lambda c: text.blank_to_null(c, trim=False),
    "holder_list": lambda c: c == HOLDER_LIST_PATH,
}


@dataclass(frozen=True)
class TypedColumn:
    """One mapped column; `parse` names a parser or is a SQL expression."""

    source: str
    name: str
    type: str = "string"
    parse: str | None = None
    nullable: bool = True
    primary_key: bool = False

    def column(self) -> Column:
        raw = F.col(f"`{self.source}`")
        if self.parse is None:
            value = raw
        elif self.parse in PARSERS:
            value = PARSERS[self.parse](raw)
        else:
            value = F.expr(self.parse)
        return value.cast(self.type).alias(self.name)


@dataclass(frozen=True)
class TypedMap:
    columns: tuple[TypedColumn, ...]
    partition_by: str | None = None

    @property
    def primary_key(self) -> str | None:
        return next((c.name for c in self.columns if c.primary_key), None)

    @property
    def id_column(self) -> str | None:
        """The source header of the primary key."""
        return next((c.source for c in self.columns if c.primary_key), None)


C = TypedColumn
# The typed column maps.
TYPED_MAPS: dict[str, TypedMap] = {
    "bids": TypedMap(
        (
            C("Bid Solicitation #", "bid_id", nullable=False, primary_key=True),
            C("Organization Name", "organization", nullable=False),
            C("Contract #", "contract_id", parse="empty_to_null"),
            C("Buyer", "buyer", nullable=False),
            C("Description", "description", nullable=False),
            C("Bid Opening Date", "bid_opening_date", "timestamp_ntz", "time"),
            C("Bid Holder List", "has_holder_list", "boolean", "holder_list", nullable=False),
            C("Awarded Vendor(s)", "awarded_vendors", parse="empty_to_null"),
            C("Status", "status", nullable=False),
            C("Alternate Id", "alternate_id", parse="empty_to_null"),
        ),
        "bid_opening_date",
    ),
    "purchase_orders": TypedMap(
        (
            C("PO #", "po_id", nullable=False, primary_key=True),
            C("Revision #", "revision_number", "int", "integer"),
            C("Date Sent", "date_sent", "date", "date"),
            C("Days to Delivery", "days_to_delivery", "int", "integer"),
            C("Status", "status", nullable=False),
            C("Total", "total_amount", "decimal(18,2)", "money"),
            C("Bid #", "bid_id", parse="empty_to_null"),
            C("Contract #", "contract_id", parse="empty_to_null"),
            C("Buyer Name", "buyer_name"),
            C("Supplier", "supplier", nullable=False),
            C("Description", "description"),
        ),
        "date_sent",
    ),
    "contracts": TypedMap(
        (
            C("Contract #", "contract_id", nullable=False, primary_key=True),
            C("Description", "description", nullable=False),
            C("Department", "department", nullable=False),
            C("Buyer", "buyer"),
            C("Supplier", "supplier", nullable=False),
            C("Start Date", "start_date", "date", "date"),
            C("End Date", "end_date", "date", "date"),
            C("Status", "status", nullable=False),
            C("Contract Amount", "contract_amount", "decimal(18,2)", "money"),
            C("Bid #", "bid_id", parse="empty_to_null"),
        ),
        "start_date",
    ),
    "vendors": TypedMap(
        (
            C("Vendor ID", "vendor_id", nullable=False, primary_key=True),
            C("Vendor Name", "vendor_name", nullable=False),
            C("Status", "status", nullable=False),
            C("City", "city"),
            C("State", "state"),
            C("Zip", "zip"),
            C("Country", "country"),
            C("Business Type", "business_type"),
            C("Commodity Codes", "commodity_codes"),
        ),
    ),
}


def typed_projection(df: DataFrame, mapping: TypedMap, run_id: str | None = None) -> DataFrame:
    """Rename, parse and cast by the map."""
    columns = [column.column() for column in mapping.columns]
    if run_id:
        columns.append(F.lit(run_id).alias("run_id"))
    return df.select(*columns)


def export_typed(
    df: DataFrame, mapping: TypedMap, path: str, converted_at: dt.datetime, run_id: str | None = None, by_date: bool = True
) -> str:
    """Write the typed rows, by year and month where the map names a date column."""
    stamp = F.lit(converted_at.isoformat(sep=" ")).cast("timestamp")
    typed = typed_projection(df, mapping, run_id).withColumn("converted_at", stamp)
    if by_date and mapping.partition_by:
        return write_year_month(typed, path, mapping.partition_by)
    return write_typed(typed, path)
