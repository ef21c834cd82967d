"""Versioned silver transforms and their catalogue."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from silverline.plans.silver import bids, contracts, purchase_orders, vendors
from silverline.plans.silver.common import SilverRun, Transform

CATALOGUE: list[Transform] = [
    *purchase_orders.TRANSFORMS,
    *bids.TRANSFORMS,
    *contracts.TRANSFORMS,
    *vendors.TRANSFORMS,
]


def version_key(version: str) -> tuple[int, ...]:
    """Sort key that puts v0.10.0 after v0.2.0."""
    return tuple(int(part) for part in version.lstrip("v").split("."))


def find(dataset: str, version: str | None = None, variant: str | None = None) -> Transform:
    """A transform by version, or the newest one of the dataset's main line."""
    known = [t for t in CATALOGUE if t.dataset == dataset and t.variant == variant]
    if version:
        known = [t for t in known if t.version == version]
    if not known:
        raise KeyError(f"no silver transform for {dataset} {version or ''} {variant or ''}".strip())
    return max(known, key=lambda t: version_key(t.version))


def sql_transform(bronze: DataFrame, sql: str, version: str, snapshot_id: str) -> DataFrame:
    """Run a user's transform written in SQL.

    `{bronze_table}`, `{transform_version}` and `{snapshot_id}` are filled in.
    """
    for value in (version, snapshot_id):
        if not re.fullmatch(r"[\w.\-]+", value):
            raise ValueError(f"not a plain identifier: {value}")
    view = f"bronze_{re.sub(r'[^0-9A-Za-z]', '_', snapshot_id)}"
    bronze.createOrReplaceTempView(view)
    filled = sql.replace("{bronze_table}", view)
    filled = filled.replace("{transform_version}", version).replace("{snapshot_id}", snapshot_id)
    return bronze.sparkSession.sql(filled)


__all__ = ["CATALOGUE", "SilverRun", "Transform", "find", "sql_transform", "version_key"]
