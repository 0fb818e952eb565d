"""Business parameters of the feeds.

Everything a retailer would set for itself (the flagship catalog, which locations are stores or
distribution centres, how they are classified) has no default and is passed in.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Results only match the feeds' consumers when these texts are used as they are.
WEBSITE_SOURCES = ("GHO", "Website", "GHX", "Mobile", "Borderfree")
MARKETPLACE_SOURCES = ("Amazon", "Amazon Prime", "eBay")
INACTIVE_SOURCES = ("eBay", "Group Sales")
OFFLINE_SOURCE = "Offline"
DEFAULT_MEMBER = "miscellaneous"
UNKNOWN_PO_TYPE = "Unknown"
MIDDLE_LEVELS = ("area", "region", "district", "account")
CLOSED_STATUSES = ("billed", "closed", "pending billing")
BACKORDERED_STATUS = "backordered"
DEMAND_EVENT = "demand"
DEMAND_SINCE = dt.date(2016, 10, 16)
LOCAL_ZONE = "America/Denver"
RETIRED_BRAND_TEXT = "DO NOT USE"
RETIRED_BRAND_PREFIX = "ZZZ"
SELLABLE_ITEM_TYPES = ("inventory item", "item group", "")
PLACEHOLDER_SKUS = ("#", "##")
PLACEHOLDER_DESCRIPTIONS = ("NA", "UNKNOWN")
SERVICE_INDUSTRY = "Service & Labor"
STYLE_COLOUR_PATTERN = r"-\[?[^-]+-"
SNAPSHOT_OFFSET_HOURS = 6


@dataclass(frozen=True)
class LocationParams:
    flagship_catalog: str
    company_name: str = "Total company"
    offline_source: str = OFFLINE_SOURCE
    website_sources: tuple[str, ...] = WEBSITE_SOURCES
    marketplace_sources: tuple[str, ...] = MARKETPLACE_SOURCES
    inactive_sources: tuple[str, ...] = INACTIVE_SOURCES
    local_zone: str = LOCAL_ZONE


@dataclass(frozen=True)
class BackorderParams:
    closed_statuses: tuple[str, ...] = CLOSED_STATUSES
    backordered_status: str = BACKORDERED_STATUS
    demand_event: str = DEMAND_EVENT
    since: dt.date = DEMAND_SINCE
    local_zone: str = LOCAL_ZONE


@dataclass(frozen=True)
class EligibilityParams:
    retired_brand_text: str = RETIRED_BRAND_TEXT
    retired_brand_prefix: str = RETIRED_BRAND_PREFIX
    item_types: tuple[str, ...] = SELLABLE_ITEM_TYPES
    placeholder_skus: tuple[str, ...] = PLACEHOLDER_SKUS
    placeholder_descriptions: tuple[str, ...] = PLACEHOLDER_DESCRIPTIONS
    service_industry: str = SERVICE_INDUSTRY
    sku_pattern: str = STYLE_COLOUR_PATTERN
