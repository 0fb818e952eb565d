"""Which products take part in planning, and the exclusion flag that records it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.params import EligibilityParams


def eligible_skus(products: DataFrame, brand: DataFrame, params: EligibilityParams) -> DataFrame:
    """Skus that pass every rule.

    A product without a brand row passes the brand rules. An unknown item type, sku, special-order
    flag, industry or style does not pass its rule: those comparisons are left unguarded on purpose.
    """
    brands = brand.select("brand_extid", "brand_name", "prefix")
    unknown = F.lit("X")
    rules = (
        ~F.contains(F.coalesce(F.upper("brand_name"), unknown), F.lit(params.retired_brand_text))
        & (F.coalesce("prefix", unknown) != params.retired_brand_prefix)
        & F.col("item_type").isin(*params.item_types)
        & ~F.col("sku").isin(*params.placeholder_skus)
        & ~F.coalesce(F.upper("skudesc"), F.lit("x")).isin(*params.placeholder_descriptions)
        & (F.col("is_gso") == F.lit(False))
        & (F.col("industry") != params.service_industry)
        & F.col("styleid").isNotNull()
        & F.col("sku").rlike(params.sku_pattern)
        & (F.coalesce("netsuite_item_id", F.lit(0)) >= 0)
    )
    return (
        products.join(brands, F.col("brandid").cast("string") == F.col("brand_extid"), "left")
        .filter(rules)
        .select("sku")
    )


def flag_excluded(products: DataFrame, eligible: DataFrame) -> DataFrame:
    """Products with ``is_excluded`` false where the sku is eligible and true elsewhere.

    A merge with a clause for each side, expressed as a rebuild. A NULL sku matches nothing.
    """
    kept = eligible.select("sku").distinct().withColumn("is_eligible", F.lit(True))
    columns = [c for c in products.columns if c != "is_excluded"]
    return products.join(kept, "sku", "left").select(
        *columns, F.col("is_eligible").isNull().alias("is_excluded")
    )


def flag_changes(products: DataFrame, eligible: DataFrame) -> DataFrame:
    """Skus with a row whose stored ``is_excluded`` is not what ``flag_excluded`` would give."""
    before = products.select("sku", F.col("is_excluded").alias("was_excluded"))
    return (
        flag_excluded(before, eligible)
        .where(~F.col("was_excluded").eqNullSafe(F.col("is_excluded")))
        .select("sku")
    )
