"""Runs: the operators composed in the order their inputs require."""

from shelfcast.plans.interface import InterfaceInputs, planning_checks, planning_feeds, planning_rejects
from shelfcast.plans.products import (
    merge_events,
    merge_exclusions,
    product_dimension_merge,
    product_dimension_run,
)
from shelfcast.plans.store_inventory import store_inventory_run

__all__ = [
    "InterfaceInputs",
    "merge_events",
    "merge_exclusions",
    "planning_checks",
    "planning_feeds",
    "planning_rejects",
    "product_dimension_merge",
    "product_dimension_run",
    "store_inventory_run",
]
