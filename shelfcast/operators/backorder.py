"""Pending backorders: units still owed, the demand behind them and their value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import local_date
from shelfcast.params import BackorderParams
from shelfcast.sources import live_rows


def _demand(events: DataFrame, event_type: str, params: BackorderParams) -> DataFrame:
    return events.filter(
        (F.col(event_type) == params.demand_event)
        & (F.col("sb_event_date") >= F.lit(params.since))
    )


def open_orders(transactions: DataFrame, params: BackorderParams) -> DataFrame:
    """Distinct attributes of demand orders that are not closed. A NULL status drops."""
    status = F.col("transactions.transaction_status")
    return (
        _demand(transactions, "transactions.transaction_event_type", params)
        .filter(~F.lower(status).isin(*params.closed_statuses))
        .select(
            "transactions.transaction_extid",
            "customers.customer_firstname",
            "customers.customer_lastname",
            "customers.customer_email",
            "shipmodes.shipmode_full_name",
            "transactions.transaction_status",
            "site_channels.website_storefront_rank",
            F.col("site_channels.website_name").alias("catalog"),
            F.col("transactions.order_source_name").alias("order_source"),
        )
        .distinct()
    )


def backordered_units(
    units: DataFrame, orders: DataFrame, products: DataFrame, params: BackorderParams
) -> DataFrame:
    """Backordered units per order and sku, split by order status, catalog and source.

    A unit counts once per matching order row and once per matching product row. Each side is
    therefore counted on its own keys first and the counts are multiplied: joins see one row per
    key, and no hot order or sku is expanded only to be counted. Status splits the rows although
    it is not shown.
    """
    owed = (
        live_rows(units)
        .filter(F.col("status") == params.backordered_status)
        .groupBy("order_number", "sku")
        .agg(F.count(F.lit(1)).alias("n_units"))
    )
    order_rows = (
        orders.groupBy("transaction_extid", "transaction_status", "catalog", "order_source")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    repeated_skus = (
        products.groupBy("sku").agg(F.count(F.lit(1)).alias("n_products")).filter("n_products > 1")
    )
    quantity = F.col("n_units") * F.col("n_orders") * F.coalesce("n_products", F.lit(1))
    return (
        owed.join(order_rows, F.col("order_number") == F.col("transaction_extid"))
        .join(repeated_skus, "sku", "left")
        .select("order_number", "sku", "catalog", "order_source", quantity.alias("backordered_qty"))
    )


def flatten_details(transactions: DataFrame) -> DataFrame:
    """One row per order detail; an order without details keeps one row with NULL detail."""
    return transactions.select(
        "transactions.transaction_extid",
        "transactions.transaction_event_type",
        "employees.employee_extid",
        "catalogs.catalog_name",
        "sb_event_date",
        F.explode_outer("details").alias("detail"),
    ).select(
        "transaction_extid",
        "transaction_event_type",
        "employee_extid",
        "catalog_name",
        "sb_event_date",
        "detail.sku",
        "detail.quantity",
        "detail.amount",
    )


def demand_totals(details: DataFrame, params: BackorderParams) -> DataFrame:
    """Demand quantity, sales and first date per order and sku, for every demand detail.

    The employee splits the totals although it is not shown; equal rows then merge. Totals with
    quantity zero drop.
    """
    return (
        _demand(details, "transaction_event_type", params)
        .groupBy("transaction_extid", "sku", "employee_extid", "catalog_name")
        .agg(
            F.sum("quantity").alias("demand_quantity"),
            F.sum("amount").alias("demand_sales"),
            F.min("sb_event_date").alias("orderline_date"),
        )
        .filter(F.col("demand_quantity") != 0)
        .select(
            F.col("transaction_extid").alias("order_number"),
            "sku",
            "catalog_name",
            "demand_quantity",
            "demand_sales",
            "orderline_date",
        )
        .distinct()
    )


def demand_sales(
    details: DataFrame, backordered: DataFrame, params: BackorderParams
) -> DataFrame:
    """Demand totals of the order and sku pairs that have backordered units."""
    owed = backordered.select(F.col("order_number").alias("transaction_extid"), "sku")
    return demand_totals(details.join(owed, ["transaction_extid", "sku"], "left_semi"), params)


def _share_in_cents(sales: Column, units: Column, quantity: Column) -> Column:
    """sales * units / quantity in cents, exact before the one rounding."""
    top = (sales * 100).cast("decimal(18,0)") * (F.abs(units) * 200).cast("decimal(15,0)")
    bottom = F.abs((quantity * 100).cast("decimal(18,0)"))
    # twice the quotient and a half, both whole
    doubled = F.abs(top) + bottom
    cents = F.call_function("div", doubled, bottom * 2)
    sign = F.signum(sales) * F.signum(units) * F.signum(quantity)
    return ((cents * sign.cast("int")).cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def backorder_value(
    backordered: DataFrame, demand: DataFrame, products: DataFrame, params: BackorderParams
) -> DataFrame:
    """Units owed with their retail and cost value, for products that are not excluded.

    The join keeps pairs found on both sides, so ``demand`` may cover more than the backordered
    pairs: ``demand_totals`` and ``demand_sales`` give the same result here. The retail value is
    rounded once, half away from zero, on whole cents; totals of 10^18 cents or 10^12 units and
    above overflow, which Spark reports.
    """
    priced = products.filter(F.col("is_excluded") == F.lit(False)).select("sku", "wholesale_price")
    units = F.col("backordered_qty")
    retail = _share_in_cents(F.col("demand_sales"), units, F.col("demand_quantity"))
    return (
        backordered.join(
            demand.filter(F.col("demand_quantity") != 0).drop("catalog_name"),
            ["order_number", "sku"],
        )
        .join(priced, "sku")
        .select(
            "catalog",
            "order_source",
            "order_number",
            "sku",
            local_date(demand, "orderline_date", params.local_zone).alias("orderline_date"),
            "demand_quantity",
            F.col("demand_sales").alias("item_demand_sales"),
            units.alias("pending_backorder_u"),
            retail.alias("pending_backorder_v"),
            (F.col("wholesale_price") * units).cast("decimal(18,4)").alias("pending_backorder_c"),
        )
    )
