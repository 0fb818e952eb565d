"""Level masters: the members of every reporting level of a dimension as one list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import surrogate_key
from shelfcast.params import MIDDLE_LEVELS

LEVEL_COLUMNS = ("member_id", "member_name", "member_desc", "loc_level")


def level_members(
    df: DataFrame, levels: Sequence[tuple[str, Column, Column]], level_column: str = "loc_level"
) -> DataFrame:
    """Members of several levels from one scan: (level, name, description) per level.

    The key of a member is its level name plus its name.
    """
    level = F.explode(
        F.array(
            *[
                F.struct(F.lit(level).alias("level"), name.alias("name"), desc.alias("desc"))
                for level, name, desc in levels
            ]
        )
    )
    return df.select(level.alias("m")).select(
        surrogate_key(F.col("m.level"), F.col("m.name")).alias("member_id"),
        F.col("m.name").alias("member_name"),
        F.col("m.desc").alias("member_desc"),
        F.col("m.level").alias(level_column),
    )


def location_levels(
    catalogs: DataFrame,
    channels: DataFrame,
    locations: DataFrame,
    company_name: str,
    middle_levels: Sequence[str] = MIDDLE_LEVELS,
) -> DataFrame:
    """Company, channel, catalog, selling channel, the middle levels and location.

    The middle levels repeat the selling channels under their own key prefix. Distribution centres
    are not members of any level.
    """
    top = catalogs.sparkSession.range(1)
    company = F.lit(company_name)
    channel = F.lit("channel")
    total_key = F.lit("totalcompany")
    tops = [
        top.select(
            surrogate_key(level, total_key).alias("member_id"),
            name.alias("member_name"),
            name.alias("member_desc"),
            F.lit(level).alias("loc_level"),
        )
        for level, name in (("totalcompany", company), ("channel", channel))
    ]
    name, desc = F.col("member_name"), F.col("member_desc")
    middle = level_members(channels, [(level, name, desc) for level in middle_levels])
    parts = [
        *tops,
        catalogs.select(*LEVEL_COLUMNS),
        channels.select(*LEVEL_COLUMNS),
        middle,
        locations.filter(F.col("loc_level") != "DC_VDC").select(*LEVEL_COLUMNS),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def product_levels(products: DataFrame) -> DataFrame:
    """Product members by group, type, brand and sku.

    Our own definition: the step is known by name and place only. A product without a value at a
    level has no member there.
    """
    columns = {
        "product_group": ("productgroupdesc", "productgroupdesc"),
        "product_type": ("axis2value", "axis2value"),
        "brand": ("brandname", "brandname"),
        "sku": ("sku", "sku"),
    }
    levels = [(level, F.col(name), F.col(desc)) for level, (name, desc) in columns.items()]
    members = level_members(products, levels, "prod_level")
    return members.filter(F.col("member_name").isNotNull()).distinct()
