"""Store inventory snapshots: upsert and delta.

The steps are known by name and order only; their rules here are our own definitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STORE_SKU = ("store_id", "sku")


def upsert_snapshot(
    inventory: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str] = STORE_SKU,
    version: str = "as_of",
) -> DataFrame:
    """The newest row per key over both inputs; a tie goes to the larger remaining values.

    A maximum over the union needs one shuffle of rows already reduced map-side.
    """
    values = [c for c in inventory.columns if c not in keys and c != version]
    return (
        inventory.unionByName(snapshot)
        .groupBy(*keys)
        .agg(F.max(F.struct(version, *values)).alias("newest"))
        .select(*keys, "newest.*")
        .select(*inventory.columns)
    )


def snapshot_delta(
    previous: DataFrame,
    current: DataFrame,
    keys: Sequence[str] = STORE_SKU,
    quantity: str = "quantity",
) -> DataFrame:
    """Keys whose quantity changed, that are new, or that vanished (quantity 0).

    Both snapshots have a row per key, so summing each side over the union equals comparing them
    with a full outer join, and a hot key is reduced before the shuffle.
    """
    sides = previous.select(
        *keys, F.col(quantity).alias("before"), F.lit(None).cast("bigint").alias("after")
    ).unionByName(
        current.select(
            *keys, F.lit(None).cast("bigint").alias("before"), F.col(quantity).alias("after")
        )
    )
    return (
        sides.groupBy(*keys)
        .agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
        .filter(~F.col("before").eqNullSafe(F.col("after")))
        .select(*keys, F.coalesce("after", F.lit(0)).alias(quantity))
    )
