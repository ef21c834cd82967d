"""Fixed, versioned schemas of the exported files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class FileSchema:
    """Columns and CSV options of one dataset version. Every exported column is text.

    `multiline` says whether quoted fields hold line breaks: files that do can't be split over tasks.
    Unless it is set, every file is looked at, and only those that do are read whole.
    """

    columns: tuple[str, ...]
    primary_key: str
    options: dict[str, str] = field(default_factory=dict)
    multiline: bool | None = None

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])


# Column names and order of the exports.
_V010 = {
    "bids": FileSchema(
        (
            "Bid Solicitation #",
            "Organization Name",
            "Contract #",
            "Buyer",
            "Description",
            "Bid Opening Date",
            "Bid Holder List",
            "Awarded Vendor(s)",
            "Status",
            "Alternate Id",
        ),
        "Bid Solicitation #",
    ),
    "purchase_orders": FileSchema(
        (
            "PO #",
            "Description",
            "Vendor",
            "Organization",
            "Department",
            "Buyer",
            "Status",
            "Sent Date",
            "Total",
        ),
        "PO #",
    ),
    "contracts": FileSchema(
        (
            "Contract #",
            "Bid Solicitation #",
            "Description",
            "Vendor",
            "Type Code",
            "Dollars Spent to Date",
            "Organization",
            "Status",
            "Begin Date",
            "End Date",
        ),
        "Contract #",
    ),
    "vendors": FileSchema(
        (
            "Vendor ID",
            "Vendor Name",
            "Address",
            "City",
            "State",
            "Postal Code",
            "Contact Name",
            "Phone",
        ),
        "Vendor ID",
    ),
}
REGISTRY: dict[tuple[str, str], FileSchema] = {(name, "v0.1.0"): schema for name, schema in _V010.items()}


def schema_for(
    dataset: str, version: str = "v0.1.0", registry: dict[tuple[str, str], FileSchema] | None = None
) -> FileSchema:
    known = REGISTRY if registry is None else registry
    if (dataset, version) not in known:
        raise KeyError(f"no schema for {dataset} {version}")
    return known[(dataset, version)]


def load_registry(spark: SparkSession, path: str) -> dict[tuple[str, str], FileSchema]:
    """A registry from a JSON file: schemas → dataset → version → columns, csv_options, multiline.

    The first column is the primary key unless the entry names another; `multiline` may be left out.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    out = {}
    for dataset, versions in json.loads(text)["schemas"].items():
        for version, entry in versions.items():
            columns = tuple(entry["columns"])
            options = {k: str(v) for k, v in entry.get("csv_options", {}).items()}
            out[(dataset, version)] = FileSchema(columns, entry.get("primary_key", columns[0]), options, entry.get("multiline"))
    return out
