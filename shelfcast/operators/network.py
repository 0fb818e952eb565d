"""Fulfilment network: which facilities serve a zip area, and so a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import surrogate_key
from shelfcast.sources import live_rows


def zip_network(zip_map: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per zip area and facility, priority 1 for the best and 2 for the backup.

    The map is read once and unpivoted. A missing backup or an unknown or deleted facility drops.
    """
    facilities = zip_map.select(
        "zipcode",
        F.expr("stack(2, optimal_facility, 1, backup, 2) AS (facility_code, priority)"),
    ).distinct()
    live = live_rows(locations).select("location_extid", "name")
    return facilities.join(live, F.col("facility_code") == F.col("location_extid")).select(
        F.col("zipcode").alias("zip_code"),
        surrogate_key("location", F.col("name")).alias("inv_loc_id"),
        "priority",
    )


def store_network(network: DataFrame, locations: DataFrame) -> DataFrame:
    """Facilities of every retail location by the first three digits of its zip code.

    Duplicates stay: a location listed twice gets its facilities twice.
    """
    retail = locations.filter(
        (F.col("dc_po_type_location") == "Retail") & F.col("zipcode").isNotNull()
    ).select(
        F.col("member_id").alias("location_id"), F.substring("zipcode", 1, 3).alias("zip_area")
    )
    return network.join(retail, F.col("zip_code") == F.col("zip_area")).select(
        "location_id", "inv_loc_id", "priority"
    )
