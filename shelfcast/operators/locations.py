"""Location dimension: catalogs, selling channels, stores, web locations and distribution centres."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from shelfcast.functions import local_date, surrogate_key
from shelfcast.params import DEFAULT_MEMBER, UNKNOWN_PO_TYPE, LocationParams
from shelfcast.sources import live_rows

# Column order of the delivered location feeds.
LOCATION_COLUMNS = (
    "member_id",
    "client_id",
    "member_name",
    "member_desc",
    "loc_level",
    "selling_channel",
    "catalog_id",
    "catalog_name",
    "order_source_id",
    "order_source_name",
    "order_source_group",
    "selling_channel_group",
    "location_group",
    "merch_location_group",
    "city",
    "state",
    "zipcode",
    "active_status",
    "store_open_date",
    "store_close_date",
    "climate",
    "corp_vol_group",
    "capacity",
    "sq_footage",
    "latitude",
    "longitude",
    "store_banner",
    "drop_ship",
    "dc_po_type_location",
    "dc_flag",
    "vdc_flag",
)
DATE_COLUMNS = ("store_open_date", "store_close_date")
ATTRIBUTE_COLUMNS = (
    "member_id",
    "member_name",
    "dc_po_type_location",
    "catalog_id",
    "catalog_name",
    "order_source_id",
    "order_source_name",
    "order_source_group",
    "selling_channel_group",
    "location_group",
    "merch_location_group",
    "dc_flag",
    "vdc_flag",
    "city",
    "state",
    "zipcode",
    "active_status",
    "store_open_date",
    "store_close_date",
    "climate",
    "corp_vol_group",
    "capacity",
    "sq_footage",
    "latitude",
    "longitude",
    "store_banner",
    "drop_ship",
)
OPEN_ATTRIBUTES = tuple(f"loc_open_{n}" for n in range(1, 11))
CLASS_SCHEMA = (
    "location_extid string, store_po_type string, dc_po_type string, dc_flag string, "
    "vdc_flag string"
)
LOCATION_SCHEMA = StructType(
    [
        StructField(name, DateType() if name in DATE_COLUMNS else StringType())
        for name in LOCATION_COLUMNS
    ]
)

Ids = Sequence[int] | DataFrame


def _members(
    df: DataFrame, level: str, key: Column, name: Column, desc: Column, catalog_id: Column
) -> DataFrame:
    member_id = surrogate_key(level, key)
    return df.select(
        member_id.alias("member_id"),
        member_id.alias("client_id"),
        name.alias("member_name"),
        desc.alias("member_desc"),
        F.lit(level).alias("loc_level"),
        catalog_id.cast("string").alias("catalog_id"),
    )


def _one_row(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(1)


def _default_member(df: DataFrame, level: str) -> DataFrame:
    default = F.lit(DEFAULT_MEMBER)
    return _members(_one_row(df), level, default, default, default, default)


def catalog_members(catalog: DataFrame) -> DataFrame:
    """Live catalogs plus the default member. Named by external id, keyed by name."""
    name = F.col("catalog_name")
    members = _members(
        live_rows(catalog), "catalog", name, F.col("catalog_extid"), name, F.col("catalog_id")
    )
    return members.unionByName(_default_member(catalog, "catalog")).distinct()


def catalog_source_pairs(catalog: DataFrame, order_source: DataFrame) -> DataFrame:
    """Every live catalog with every live order source.

    The product of the two is the result itself, one row per selling channel, so there is nothing
    to join on. No broadcast is forced: Spark broadcasts a side only when it measures it below its
    threshold and spreads the product over all tasks otherwise.
    """
    catalogs = live_rows(catalog).select("catalog_id", "catalog_extid", "catalog_name")
    sources = live_rows(order_source).select("order_source_id", "order_source_name")
    return catalogs.crossJoin(sources)


def _channel_name() -> Column:
    return F.concat("catalog_name", F.lit("-"), "order_source_name")


def selling_channels(catalog: DataFrame, order_source: DataFrame) -> DataFrame:
    """One member per live catalog and order source, plus the default member."""
    name = _channel_name()
    pairs = catalog_source_pairs(catalog, order_source)
    members = _members(pairs, "selling_channel", name, name, name, F.col("catalog_id"))
    return members.unionByName(_default_member(catalog, "selling_channel")).distinct()


def source_group(name: Column, params: LocationParams) -> Column:
    return (
        F.when(name.isin(*params.website_sources), F.lit("Website"))
        .when(name.isin(*params.marketplace_sources), F.lit("Marketplace"))
        .otherwise(name)
    )


def with_channel_groups(pairs: DataFrame, params: LocationParams) -> DataFrame:
    """Reporting groups of a channel. Website channels are merchandised under their catalog."""
    name = F.col("order_source_name")
    group = source_group(name, params)
    channel_group = F.concat("catalog_name", F.lit("-"), group)
    return pairs.withColumns(
        {
            "order_source_group": group,
            "selling_channel_group": channel_group,
            "location_group": channel_group,
            "merch_location_group": F.when(
                name.isin(*params.website_sources), F.col("catalog_name")
            ).otherwise(group),
        }
    )


def location_classes(
    spark: SparkSession,
    store_po_types: Mapping[str, str],
    dc_po_types: Mapping[str, str],
    dc_flags: Mapping[str, str],
    vdc_flags: Mapping[str, str],
) -> DataFrame:
    """Classification table from maps by external id, for callers without such a table.

    Stores and distribution centres classify some ids differently, so each has its own map.
    """
    maps = (store_po_types, dc_po_types, dc_flags, vdc_flags)
    ids = sorted(set().union(*maps))
    return spark.createDataFrame([(i, *(m.get(i) for m in maps)) for i in ids], CLASS_SCHEMA)


def with_location_classes(locations: DataFrame, classes: DataFrame) -> DataFrame:
    """Purchase-order type and DC/VDC flags by external id; ids not listed get the defaults.

    ``classes`` has one row per external id.
    """
    return (
        locations.join(classes, "location_extid", "left")
        .withColumns(
            {
                "store_po_type": F.coalesce("store_po_type", F.lit(UNKNOWN_PO_TYPE)),
                "dc_po_type": F.coalesce("dc_po_type", F.lit(UNKNOWN_PO_TYPE)),
                "dc_flag": F.coalesce("dc_flag", F.lit("0")),
                "vdc_flag": F.coalesce("vdc_flag", F.lit("0")),
            }
        )
    )


def _allowed(locations: DataFrame, ids: Ids) -> DataFrame:
    live = live_rows(locations)
    if isinstance(ids, DataFrame):
        return live.join(ids, "location_id", "left_semi")
    return live.filter(F.col("location_id").isin(*ids))


def _location_rows(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """The 31 location columns in order; a column without a value is a typed NULL."""
    return df.select(*[value.alias(name) for name, value in values.items()]).to(LOCATION_SCHEMA)


def _channel_columns() -> dict[str, Column]:
    return {
        "selling_channel": _channel_name(),
        "catalog_id": F.col("catalog_extid"),
        "catalog_name": F.col("catalog_name"),
        "order_source_id": F.col("order_source_id").cast("string"),
        "order_source_name": F.col("order_source_name"),
        "order_source_group": F.col("order_source_group"),
        "selling_channel_group": F.col("selling_channel_group"),
        "dc_flag": F.lit("0"),
        "vdc_flag": F.lit("0"),
    }


def _named(level: str, name: Column, loc_level: str) -> dict[str, Column]:
    member_id = surrogate_key(level, name)
    return {
        "member_id": member_id,
        "client_id": member_id,
        "member_name": name,
        "member_desc": name,
        "loc_level": F.lit(loc_level),
    }


def store_location_rows(
    catalog: DataFrame,
    order_source: DataFrame,
    locations: DataFrame,
    classes: DataFrame,
    store_ids: Ids,
    params: LocationParams,
) -> DataFrame:
    """Retail stores, before duplicates are removed.

    Only the flagship catalog has a member per store. For the other catalogs the store shows only
    in its purchase-order type, so they meet the distinct types instead of all stores and no row is
    made that the final distinct would drop again.
    """
    pairs = catalog_source_pairs(catalog, order_source)
    offline = with_channel_groups(
        pairs.filter(F.col("order_source_name") == params.offline_source), params
    )
    stores = with_location_classes(_allowed(locations, store_ids), classes)
    is_flagship = F.col("catalog_name").eqNullSafe(params.flagship_catalog)

    store_name = F.concat(_channel_name(), F.lit("-"), "name")
    flagship = _location_rows(
        offline.filter(is_flagship).crossJoin(
            stores.select(
                "name",
                "city",
                "state",
                "zipcode",
                "store_po_type",
                local_date(stores, "date_last_modified", params.local_zone).alias("opened"),
            )
        ),
        _channel_columns()
        | _named("location", store_name, "location")
        | {
            "location_group": store_name,
            "merch_location_group": F.col("name"),
            "city": F.col("city"),
            "state": F.col("state"),
            "zipcode": F.substring("zipcode", 1, 5),
            "active_status": F.lit("TRUE"),
            "store_open_date": F.col("opened"),
            "dc_po_type_location": F.col("store_po_type"),
        },
    )
    others = _location_rows(
        offline.filter(~is_flagship).crossJoin(stores.select("store_po_type").distinct()),
        _channel_columns()
        | _named("location", _channel_name(), "location")
        | {
            "location_group": F.col("location_group"),
            "merch_location_group": F.lit(DEFAULT_MEMBER),
            "active_status": F.lit("FALSE"),
            "dc_po_type_location": F.col("store_po_type"),
        },
    )
    return flagship.unionByName(others)


def store_locations(
    catalog: DataFrame,
    order_source: DataFrame,
    locations: DataFrame,
    classes: DataFrame,
    store_ids: Ids,
    params: LocationParams,
) -> DataFrame:
    """Retail stores: catalogs through the one offline source at each allowed store.

    A member of a catalog other than the flagship can carry several purchase-order types, so
    member ids are not unique here.
    """
    return store_location_rows(
        catalog, order_source, locations, classes, store_ids, params
    ).distinct()


def web_locations(
    catalog: DataFrame, order_source: DataFrame, params: LocationParams
) -> DataFrame:
    """One location per live catalog and source other than the offline one."""
    pairs = catalog_source_pairs(catalog, order_source)
    source = F.col("order_source_name")
    online = with_channel_groups(pairs.filter(source != params.offline_source), params)
    return _location_rows(
        online,
        _channel_columns()
        | _named("location", _channel_name(), "location")
        | {
            "location_group": F.col("location_group"),
            "merch_location_group": F.col("merch_location_group"),
            "active_status": F.when(
                source.isin(*params.inactive_sources), F.lit("FALSE")
            ).otherwise(F.lit("TRUE")),
            "dc_po_type_location": F.lit(UNKNOWN_PO_TYPE),
        },
    )


def dc_location_rows(locations: DataFrame, classes: DataFrame, dc_ids: Ids) -> DataFrame:
    """Distribution centres, before duplicates are removed."""
    centres = with_location_classes(_allowed(locations, dc_ids), classes)
    return _location_rows(
        centres,
        _named("location", F.col("name"), "DC_VDC")
        | {
            "city": F.col("city"),
            "state": F.col("state"),
            "zipcode": F.substring("zipcode", 1, 5),
            "active_status": F.lit("FALSE"),
            "dc_po_type_location": F.col("dc_po_type"),
            "dc_flag": F.col("dc_flag"),
            "vdc_flag": F.col("vdc_flag"),
        },
    )


def dc_locations(locations: DataFrame, classes: DataFrame, dc_ids: Ids) -> DataFrame:
    """Distribution centres: allowed locations at their own level, outside every channel."""
    return dc_location_rows(locations, classes, dc_ids).distinct()


def default_location(df: DataFrame) -> DataFrame:
    """The row that facts without a known location point to."""
    default = F.lit(DEFAULT_MEMBER)
    named = (
        "selling_channel",
        "catalog_id",
        "catalog_name",
        "order_source_id",
        "order_source_name",
        "order_source_group",
        "selling_channel_group",
        "location_group",
        "merch_location_group",
        "dc_po_type_location",
    )
    return _location_rows(
        _one_row(df),
        _named("location", default, "location")
        | {name: default for name in named}
        | {"active_status": F.lit("FALSE"), "dc_flag": F.lit("0"), "vdc_flag": F.lit("0")},
    )


def location_table(stores: DataFrame, web: DataFrame, centres: DataFrame) -> DataFrame:
    """All locations and the default one, each once. The parts may hold duplicates."""
    parts = [stores, web, centres, default_location(stores)]
    return reduce(DataFrame.unionByName, parts).distinct()


def location_attributes(locations: DataFrame) -> DataFrame:
    """Attributes of each location and ten columns kept open for the consumer."""
    return locations.select(
        *ATTRIBUTE_COLUMNS,
        *[F.lit(None).cast("string").alias(name) for name in OPEN_ATTRIBUTES],
    ).distinct()
