"""The planning interface: dimension, network, size-group and backorder feeds of one run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import surrogate_key
from shelfcast.operators.backorder import (
    backorder_value,
    backordered_units,
    demand_sales,
    flatten_details,
    open_orders,
)
from shelfcast.operators.levels import location_levels, product_levels
from shelfcast.operators.locations import (
    Ids,
    catalog_members,
    dc_location_rows,
    location_attributes,
    location_table,
    selling_channels,
    store_location_rows,
    web_locations,
)
from shelfcast.operators.network import store_network, zip_network
from shelfcast.operators.quality import FeedCheck, reject_summary
from shelfcast.operators.sizing import size_groups, sku_size_groups
from shelfcast.params import BackorderParams, LocationParams
from shelfcast.session import apply_scale_settings
from shelfcast.sinks import stage_table
from shelfcast.sinks.feeds import run_stamp
from shelfcast.sources import live_rows


@dataclass(frozen=True)
class InterfaceInputs:
    catalog: DataFrame
    order_source: DataFrame
    locations: DataFrame
    classes: DataFrame
    store_ids: Ids
    dc_ids: Ids
    zip_map: DataFrame
    size_rules: DataFrame
    products: DataFrame
    units: DataFrame
    transactions: DataFrame


def location_dimension(
    catalog: DataFrame,
    order_source: DataFrame,
    locations: DataFrame,
    classes: DataFrame,
    store_ids: Ids,
    dc_ids: Ids,
    params: LocationParams,
) -> DataFrame:
    return location_table(
        store_location_rows(catalog, order_source, locations, classes, store_ids, params),
        web_locations(catalog, order_source, params),
        dc_location_rows(locations, classes, dc_ids),
    )


def pending_backorders(
    units: DataFrame,
    transactions: DataFrame,
    products: DataFrame,
    params: BackorderParams,
    base: str,
    run_id: str,
    headers: DataFrame | None = None,
) -> DataFrame:
    """Backorder value from the details of owed pairs of order and sku only.

    Open orders come from the transactions without their details. ``headers`` holds these where the
    transactions are not stored but made from orders and lines, so the two are not joined for nothing.

    The owed units are stored under ``base``, as they are read twice: as a filter of the details,
    before these are added up, and as rows of the result. The stored table has one scan and a filter
    (which all rows pass), so where it is too large to broadcast, Spark can make a Bloom filter of
    its orders and drop the other orders in the scan of the transactions (``SCALE_SETTINGS``). What
    is left is shuffled once, by order and sku, for the filter, the totals and the result.
    """
    owed = stage_table(
        backordered_units(
            units, open_orders(transactions if headers is None else headers, params), products, params
        ),
        f"{base}/backordered",
        run_id,
    ).where("backordered_qty > 0")
    demand = demand_sales(flatten_details(transactions), owed, params)
    return backorder_value(owed, demand, products, params)


def planning_feeds(
    inputs: InterfaceInputs,
    location_params: LocationParams,
    backorder_params: BackorderParams,
    base: str,
    run_ts: dt.datetime,
) -> Mapping[str, DataFrame]:
    """Every feed of a run by name, ready for ``sinks.export_run``.

    Tables that several feeds read are stored under ``base`` first. The zip network is built
    before the store network that reads it.
    """
    apply_scale_settings(inputs.catalog.sparkSession)
    run_id = run_stamp(run_ts)

    def stored(name: str, df: DataFrame) -> DataFrame:
        return stage_table(df, f"{base}/{name}", run_id)

    catalogs = catalog_members(inputs.catalog)
    channels = stored("channel", selling_channels(inputs.catalog, inputs.order_source))
    locations = stored(
        "location",
        location_dimension(
            inputs.catalog,
            inputs.order_source,
            inputs.locations,
            inputs.classes,
            inputs.store_ids,
            inputs.dc_ids,
            location_params,
        ),
    )
    network = stored("zip_network", zip_network(inputs.zip_map, inputs.locations))
    sku_groups = stored("sku_size_group", sku_size_groups(inputs.products, inputs.size_rules))
    return {
        "location_attributes": location_attributes(locations),
        "location_levels": location_levels(
            catalogs, channels, locations, location_params.company_name
        ),
        "product_levels": product_levels(inputs.products),
        "zip_network": network,
        "store_network": store_network(network, locations),
        "sku_size_groups": sku_groups,
        "size_groups": size_groups(sku_groups),
        "backorder_sales": stored(
            "backorder_sales",
            pending_backorders(
                inputs.units, inputs.transactions, inputs.products, backorder_params, base, run_id
            ),
        ),
    }


def planning_checks(
    feeds: Mapping[str, DataFrame], catalog: DataFrame, locations: DataFrame
) -> list[FeedCheck]:
    """What the feeds that others refer to are held to.

    A member is listed once for each PO type. A facility is any live location, stores included. The
    backorder feed hides the employee and the status that split its rows, so its key repeats.
    """
    facilities = live_rows(locations).select(surrogate_key("location", F.col("name")).alias("key"))
    return [
        FeedCheck(
            "location_attributes",
            feeds["location_attributes"],
            ["member_id", "dc_po_type_location"],
        ),
        FeedCheck(
            "zip_network",
            feeds["zip_network"],
            ["zip_code", "inv_loc_id", "priority"],
            {"inv_loc_id": facilities},
        ),
        FeedCheck(
            "backorder_sales",
            feeds["backorder_sales"],
            ["catalog", "order_source", "order_number", "sku"],
            {"catalog": catalog.select("catalog_name")},
            unique=False,
        ),
    ]


def planning_rejects(
    feeds: Mapping[str, DataFrame], catalog: DataFrame, locations: DataFrame
) -> DataFrame:
    """Rejected rows of the feeds that others refer to."""
    return reject_summary(planning_checks(feeds, catalog, locations))
