"""Size groups: rules per size axis, refined by brand or merchandise class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RULE_ORDER = ("optional_brand", "optional_mc", "group_name", "optional_disable")


def rule_lookup(rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first rule of each key, unless that rule is disabled.

    Ranking comes before the disable filter on purpose: a disabled first rule hides its whole key.
    Rules rank by brand, with class, group and disable mark making the order total (NULL first).
    """
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in RULE_ORDER])
    return (
        rules.withColumn("rule_rank", F.row_number().over(first))
        .filter((F.col("rule_rank") == 1) & F.col("optional_disable").isNull())
        .select(*keys, "group_name")
    )


def sku_size_groups(products: DataFrame, rules: DataFrame) -> DataFrame:
    """Size group of every product that is not excluded.

    The brand rule wins over the class rule, and that over the axis rule. A rule without a group
    name still decides the axis and leaves the name to the next rule. No broadcast is forced: each
    lookup has one row per key, so a hot axis is split by AQE without copying products.
    """
    by_brand = rule_lookup(rules, ["axis2", "optional_brand"]).select(
        F.col("axis2").alias("brand_axis"),
        "optional_brand",
        F.col("group_name").alias("brand_group"),
    )
    by_class = rule_lookup(rules, ["axis2", "optional_mc"]).select(
        F.col("axis2").alias("class_axis"), "optional_mc", F.col("group_name").alias("class_group")
    )
    by_axis = rule_lookup(rules, ["axis2"]).select(
        F.col("axis2").alias("only_axis"), F.col("group_name").alias("axis_group")
    )
    axis = F.col("axis2value")
    return (
        products.filter(F.col("is_excluded") == F.lit(False))
        .select("sku", "axis2value", "brandname", "merchandise_class", "productgroupdesc")
        .join(
            by_brand,
            (axis == F.col("brand_axis")) & (F.col("brandname") == F.col("optional_brand")),
            "left",
        )
        .join(
            by_class,
            (axis == F.col("class_axis")) & (F.col("merchandise_class") == F.col("optional_mc")),
            "left",
        )
        .join(by_axis, axis == F.col("only_axis"), "left")
        .select(
            "sku",
            F.coalesce("brand_axis", "class_axis", "only_axis").alias("axis_2"),
            F.concat(
                "productgroupdesc",
                F.lit(" "),
                F.coalesce("brand_group", "class_group", "axis_group"),
            ).alias("size_group_name"),
        )
        .distinct()
    )


def size_groups(sku_groups: DataFrame) -> DataFrame:
    return sku_groups.select("size_group_name", "axis_2").dropna().distinct()
