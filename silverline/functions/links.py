"""Record ids: links to the portal page of a record, and id format checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Page templates and id formats by record type. The portal host is a setting.
LINK_TEMPLATES = {
    "purchase_order": "/bso/external/purchaseorder/poSummary.sdo?docId={ID}&releaseNbr=0&external=true&parentUrl=close",
    "contract": "/bso/external/purchaseorder/poSummary.sdo?docId={ID}&releaseNbr=0&external=true&parentUrl=close",
    "bid_detail": "/bso/external/bidDetail.sdo?docId={ID}&external=true&parentUrl=close",
    "bid_holder_list": "/bso/external/bidAckList.sdo?bidId={ID}",
    "vendor": "/bso/external/vendor/vendorProfileOrgInfo.sda?external=true&vendorId={ID}",
}
HOLDER_LIST_PATH = "/bso/external/bidAckList.sdo"
HOLDER_LIST_CONDITION = "View List"
ID_FORMATS = {
    "purchase_order": r"^.+$",
    "contract": r"^(\d{2})?[A-Z]+-([A-Z]{2}\d+|NV\d{2}-\d+)$",
    "bid_detail": r"^(\d{2})?[A-Z]+-S\d+$",
    "bid_holder_list": r"^(\d{2})?[A-Z]+-S\d+$",
    "vendor": r"^VEN\d+$",
}
DEFAULT_HOST = "portal.example"


def record_link(record_id: Column, record_type: str, host: str = DEFAULT_HOST) -> Column:
    """Link to a record; NULL for a blank id. Spaces become `+`."""
    if record_type not in LINK_TEMPLATES:
        raise ValueError(f"unknown record type: {record_type}")
    head, tail = LINK_TEMPLATES[record_type].split("{ID}")
    encoded = F.replace(F.trim(record_id), F.lit(" "), F.lit("+"))
    return F.when(
        F.trim(record_id) != "", F.concat(F.lit(f"https://{host}{head}"), encoded, F.lit(tail))
    )


def holder_list_link(record_id: Column, holder_list: Column, host: str = DEFAULT_HOST) -> Column:
    """The holder-list page, only where the export says that there is one."""
    return F.when(
        F.trim(holder_list) == HOLDER_LIST_CONDITION, record_link(record_id, "bid_holder_list", host)
    )


def has_valid_id(record_id: Column, record_type: str) -> Column:
    """Whether the id has the format of its record type (FALSE for NULL)."""
    if record_type not in ID_FORMATS:
        raise ValueError(f"unknown record type: {record_type}")
    return F.coalesce(record_id.rlike(ID_FORMATS[record_type]), F.lit(False))
