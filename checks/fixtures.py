"""The feeds' input tables derived from the given parquet tables (see FIXTURES.md, section 5).

``checks.oracle`` holds the same rules in SQL.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.eligibility import eligible_skus, flag_excluded
from shelfcast.params import BackorderParams, EligibilityParams, LocationParams
from shelfcast.plans import InterfaceInputs
from shelfcast.session import apply_scale_settings, scratch_path
from shelfcast.sinks import stage_table

FLAGSHIP = "AMERICA"
LOCATION_PARAMS = LocationParams(flagship_catalog=FLAGSHIP)
BACKORDER_PARAMS = BackorderParams(since=dt.date(1996, 10, 16))
ELIGIBILITY_PARAMS = EligibilityParams()
STOCK_DATE = dt.date(2000, 12, 31)


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def part_sku(partkey: str) -> Column:
    key = F.col(partkey)
    size = F.when(key % 17 == 0, "").otherwise(_text("-S", key % 50))
    return _text("P", key, "-C", key % 6, size)


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


class Tables:
    """The given tables of one folder and the inputs derived from them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = apply_scale_settings(spark)
        self.sf_dir = sf_dir
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._given[name]

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        return stage_table(df, scratch_path(self.spark, name), "input")

    @cached_property
    def catalog(self) -> DataFrame:
        """Regions that have customers. Stored, as the real table is: plans know its size."""
        customers = self.given("customer").select("c_nationkey").distinct()
        nations = customers.join(
            self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return self._stored(
            "catalog",
            self.given("region")
            .join(nations, F.col("r_regionkey") == F.col("n_regionkey"), "left_semi")
            .select(
                F.col("r_regionkey").alias("catalog_id"),
                _text("CAT", F.col("r_regionkey")).alias("catalog_extid"),
                F.col("r_name").alias("catalog_name"),
                (F.col("r_regionkey") == 4).alias("is_deleted"),
            ),
        )

    @staticmethod
    def _source_name(digit: Column) -> Column:
        return (
            F.when(digit == "1", "Website")
            .when(digit == "2", "Mobile")
            .when(digit == "3", "Amazon")
            .when(digit == "4", "eBay")
            .otherwise("Offline")
        )

    @cached_property
    def order_source(self) -> DataFrame:
        digit = F.substring("o_orderpriority", 1, 1)
        return self._stored(
            "order-source",
            self.given("orders")
            .select(digit.alias("digit"))
            .distinct()
            .select(
                F.col("digit").cast("int").alias("order_source_id"),
                self._source_name(F.col("digit")).alias("order_source_name"),
                F.lit(False).alias("is_deleted"),
            ),
        )

    @cached_property
    def locations(self) -> DataFrame:
        key = F.col("s_suppkey")
        zipcode = _text((key % 40) * 2003 + 10000, "-0001")
        return (
            self.given("supplier")
            .join(self.given("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.alias("location_id"),
                _text("L", key).alias("location_extid"),
                F.col("s_name").alias("name"),
                _text(F.col("n_name"), " CITY").alias("city"),
                F.col("r_name").alias("state"),
                F.when(key % 13 != 12, zipcode).alias("zipcode"),
                F.expr(
                    "TIMESTAMP_NTZ'2020-01-01 03:00:00' + "
                    "make_dt_interval(cast(s_suppkey % 1000 AS int))"
                ).alias("date_last_modified"),
                (key % 25 == 24).alias("is_deleted"),
            )
        )

    @cached_property
    def location_classes(self) -> DataFrame:
        key = F.col("s_suppkey")
        kind = key % 5
        return self.given("supplier").select(
            _text("L", key).alias("location_extid"),
            F.when(kind == 0, "Closeout")
            .when(kind == 1, "Unknown")
            .when(kind.isin(2, 3), "Retail")
            .alias("store_po_type"),
            F.when(kind == 0, "Closeout")
            .when(kind == 1, "Retail or Closeout")
            .when(kind.isin(2, 3), "Retail")
            .alias("dc_po_type"),
            F.when(kind == 1, "1").when(kind != 4, "0").alias("dc_flag"),
            F.when(kind.isin(0, 2), "1").when(kind != 4, "0").alias("vdc_flag"),
        )

    @cached_property
    def store_ids(self) -> DataFrame:
        return self.given("supplier").filter("s_acctbal >= 2000").select(
            F.col("s_suppkey").alias("location_id")
        )

    @cached_property
    def dc_ids(self) -> DataFrame:
        return self.given("supplier").filter("s_acctbal < 2000").select(
            F.col("s_suppkey").alias("location_id")
        )

    @cached_property
    def zip_map(self) -> DataFrame:
        best, backup = F.min("location_extid"), F.max("location_extid")
        return (
            self.locations.groupBy(F.substring("zipcode", 1, 3).alias("zipcode"))
            .agg(best.alias("optimal_facility"), F.when(backup != best, backup).alias("backup"))
        )

    @cached_property
    def brand(self) -> DataFrame:
        number = F.substring_index("p_brand", "#", -1)
        return (
            self.given("part")
            .filter("p_brand <> 'Brand#25'")
            .select(number.alias("brand_extid"), "p_brand")
            .distinct()
            .select(
                "brand_extid",
                F.when(F.col("brand_extid") == "3", "Old - do not use")
                .otherwise(F.col("p_brand"))
                .alias("brand_name"),
                F.when(F.col("brand_extid") == "5", "ZZZ")
                .when(F.col("brand_extid") != "7", "PX")
                .alias("prefix"),
            )
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        key = F.col("p_partkey")
        wholesale = money("p_retailprice") * F.lit("0.5").cast("decimal(2,1)")
        return self.given("part").select(
            part_sku("p_partkey").alias("sku"),
            F.when(key % 23 != 0, _text("ST", key)).alias("styleid"),
            F.substring_index("p_brand", "#", -1).cast("int").alias("brandid"),
            F.col("p_brand").alias("brandname"),
            F.when((key % 5).isin(0, 3), "inventory item")
            .when(key % 5 == 1, "item group")
            .when(key % 5 == 2, "")
            .when(key % 2 == 0, "kit")
            .alias("item_type"),
            F.when(key % 31 == 0, "Unknown")
            .when(key % 37 != 0, F.col("p_name"))
            .alias("skudesc"),
            F.when(key % 11 == 0, True).when(key % 13 != 0, False).alias("is_gso"),
            F.when(key % 41 == 0, "Service & Labor")
            .when(key % 43 != 0, "Outdoor")
            .alias("industry"),
            F.when(key % 19 == 0, -key).when(key % 7 != 0, key).alias("netsuite_item_id"),
            F.col("p_type").alias("axis2value"),
            _text("MC", F.col("p_size") % 10).alias("merchandise_class"),
            F.when(key % 29 != 0, _text("Group ", key % 9)).alias("productgroupdesc"),
            wholesale.cast("decimal(18,4)").alias("wholesale_price"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return flag_excluded(
            self.raw_products, eligible_skus(self.raw_products, self.brand, ELIGIBILITY_PARAMS)
        )

    @cached_property
    def size_rules(self) -> DataFrame:
        """Brand rules where a brand runs large, class rules for three classes, axis rules.

        One aggregate over all parts is stored; each of its rows then becomes the rules it stands
        for, and these are stored again, as the delivered rules are.
        """
        nothing = F.lit(None).cast("string")
        kinds = self._stored(
            "kinds",
            self.given("part")
            .select(
                F.col("p_type").alias("axis2"),
                F.col("p_brand").alias("brand"),
                _text("MC", F.col("p_size") % 10).alias("mc"),
                "p_size",
            )
            .groupBy("axis2", "brand", "mc")
            .agg(F.sum("p_size").alias("total_size"), F.count(F.lit(1)).alias("n")),
        )
        by_brand = (
            kinds.groupBy("axis2", "brand")
            .agg(F.sum("total_size").alias("total_size"), F.sum("n").alias("n"))
            .filter("total_size > 25 * n")
        )
        number = F.substring_index("brand", "#", -1).cast("int")

        def rule(df: DataFrame, name: Column, brand: Column, mc: Column, off: Column) -> DataFrame:
            return df.select(
                "axis2",
                name.alias("group_name"),
                F.lit("SG").alias("sizing_group"),
                brand.alias("optional_brand"),
                mc.alias("optional_mc"),
                F.when(off, "Y").alias("optional_disable"),
            )

        by_class = kinds.filter(
            "axis2 <> 'PROMO' AND mc IN ('MC1', 'MC2', 'MC3')"
        ).select("axis2", "mc").distinct()
        by_axis = kinds.filter("axis2 <> 'SMALL'").select("axis2").distinct()
        return self._stored(
            "size-rules",
            rule(
                by_brand,
                F.when(number % 6 != 0, _text("B-", F.col("brand"))),
                F.col("brand"),
                nothing,
                number % 4 == 0,
            )
            .unionByName(
                rule(by_class, _text("C-", F.col("mc")), nothing, F.col("mc"), F.col("mc") == "MC3")
            )
            .unionByName(
                rule(
                    by_axis,
                    _text("D-", F.col("axis2")),
                    nothing,
                    nothing,
                    F.col("axis2") == "LARGE",
                )
            ),
        )

    @cached_property
    def units(self) -> DataFrame:
        """One row per unit of each line."""
        n = (1 + F.col("l_quantity").cast("int") % 3).cast("int")
        return self.given("lineitem").select(
            F.col("l_orderkey").alias("order_number"),
            part_sku("l_partkey").alias("sku"),
            F.when(F.col("l_returnflag") == "R", "backordered").otherwise("filled").alias("status"),
            (F.col("l_linenumber") == 6).alias("is_deleted"),
            F.explode(F.sequence(F.lit(1), n)).alias("unit"),
        ).drop("unit")

    @cached_property
    def order_headers(self) -> DataFrame:
        """Order, customer, shipping and channel of every order, as the transactions hold them.

        What a scan of the stored nested table reads when no detail column is asked for.
        """
        key = F.col("o_orderkey")
        status = (
            F.when(F.col("o_orderstatus") == "F", "Billed")
            .when(F.col("o_orderstatus") == "O", "Pending Fulfillment")
            .otherwise("Partially Fulfilled")
        )
        return (
            self.given("orders")
            .join(self.given("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                "o_orderkey",
                "o_custkey",
                F.struct(
                    key.alias("transaction_extid"),
                    status.alias("transaction_status"),
                    F.when(key % 10 == 0, "return")
                    .otherwise("demand")
                    .alias("transaction_event_type"),
                    self._source_name(F.substring("o_orderpriority", 1, 1)).alias(
                        "order_source_name"
                    ),
                ).alias("transactions"),
                F.struct(
                    F.substring_index("c_name", "#", 1).alias("customer_firstname"),
                    F.substring_index("c_name", "#", -1).alias("customer_lastname"),
                    _text(F.lower("c_name"), "@example.com").alias("customer_email"),
                ).alias("customers"),
                F.struct(_text("Ship ", key % 4).alias("shipmode_full_name")).alias("shipmodes"),
                F.struct(
                    F.col("r_name").alias("website_name"),
                    F.col("r_regionkey").alias("website_storefront_rank"),
                ).alias("site_channels"),
                F.struct(F.col("r_name").alias("catalog_name")).alias("catalogs"),
                F.expr(
                    "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 AS int))"
                ).alias("sb_event_date"),
            )
        )

    @cached_property
    def order_details(self) -> DataFrame:
        """Lines nested by order, supplier and ship date, stored: (o_orderkey, l_suppkey, details).

        The nesting key is the same at any size and splits a large order over as many rows as it has
        deliveries. Gathering does not reduce anything, so lines are shuffled first.
        """
        quantity = F.when(F.col("l_linenumber") == 7, 0).otherwise(F.col("l_quantity"))
        nested = ["l_orderkey", "l_suppkey", "l_shipdate"]
        return self._stored(
            "order-details",
            self.given("lineitem")
            .select(
                *nested,
                F.struct(
                    part_sku("l_partkey").alias("sku"),
                    quantity.cast("decimal(18,2)").alias("quantity"),
                    money("l_extendedprice").alias("amount"),
                ).alias("detail"),
            )
            .repartition(*nested)
            .groupBy(*nested)
            .agg(F.collect_list("detail").alias("details"))
            .select("l_orderkey", "l_suppkey", "details"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """Nested transactions: rows of an order with the details of one delivery in an array; the
        supplier decides the employee. The feeds read any number of rows per order.

        Orders without lines are added apart: an inner join lets AQE split the rows of a hot order,
        which a left join from the orders would not.
        """
        details, headers = self.order_details, self.order_headers
        filled = headers.join(details, F.col("o_orderkey") == F.col("l_orderkey"))
        empty = headers.join(
            details.select("l_orderkey").distinct(),
            F.col("o_orderkey") == F.col("l_orderkey"),
            "left_anti",
        ).select(
            "*",
            F.lit(0).cast("bigint").alias("l_suppkey"),
            F.array().cast(details.schema["details"].dataType).alias("details"),
        )
        employee = _text("E", (F.col("o_custkey") + F.col("l_suppkey") % 2) % 7)
        return (
            filled.drop("l_orderkey")
            .unionByName(empty)
            .withColumn("employees", F.struct(employee.alias("employee_extid")))
            .drop("o_orderkey", "o_custkey", "l_suppkey")
        )

    @cached_property
    def inputs(self) -> InterfaceInputs:
        return InterfaceInputs(
            catalog=self.catalog,
            order_source=self.order_source,
            locations=self.locations,
            classes=self.location_classes,
            store_ids=self.store_ids,
            dc_ids=self.dc_ids,
            zip_map=self.zip_map,
            size_rules=self.size_rules,
            products=self.products,
            units=self.units,
            transactions=self.transactions,
        )

    def stocks(self, **rows: Column) -> DataFrame:
        """Units per store (supplier) and sku in one pass over the lines: a column for each condition
        on a line, null where no line satisfies it."""
        units = F.col("l_quantity").cast("bigint")
        return (
            self.given("lineitem")
            .groupBy(F.col("l_suppkey").alias("store_id"), "l_partkey")
            .agg(*[F.sum(F.when(condition, units)).alias(name) for name, condition in rows.items()])
            .select("store_id", part_sku("l_partkey").alias("sku"), *rows)
        )

    @property
    def _lines_before(self) -> Column:
        """Lines up to a date."""
        return F.col("l_shipdate") < F.lit(STOCK_DATE + dt.timedelta(days=1))

    @property
    def _lines_after(self) -> Column:
        """All lines but those returned, which have left the stock."""
        return F.col("l_returnflag") != "R"

    @cached_property
    def inventory_before(self) -> DataFrame:
        """Stock up to a date."""
        return self.stocks(quantity=self._lines_before).filter("quantity IS NOT NULL")

    @cached_property
    def inventory_after(self) -> DataFrame:
        """Stock of all lines; what was returned has left it."""
        return self.stocks(quantity=self._lines_after).filter("quantity IS NOT NULL")

    def stored_inventories(self) -> tuple[DataFrame, DataFrame]:
        """The stock before and after, counted in one pass over the lines and stored side by side."""
        both = self._stored("stock", self.stocks(before=self._lines_before, after=self._lines_after))
        return tuple(
            both.filter(F.col(side).isNotNull()).select("store_id", "sku", F.col(side).alias("quantity"))
            for side in ("before", "after")
        )

    @cached_property
    def first_source(self) -> DataFrame:
        """Products of the first source: the smaller sizes."""
        return self._sized_products("p_size <= 34", changed=False)

    @cached_property
    def second_source(self) -> DataFrame:
        """Products of the second source: larger sizes, with changed prices and texts."""
        return self._sized_products("p_size BETWEEN 17 AND 42", changed=True)

    @cached_property
    def third_source(self) -> DataFrame:
        """A later delivery: small sizes that left come back, others leave, the largest are new,
        some have lost their key."""
        later = self._sized_products("p_size <= 25 OR p_size > 40", changed=False)
        key = F.substring_index(F.substring_index("sku", "-", 1), "P", -1).cast("bigint")
        raised = F.col("wholesale_price") * F.lit("1.2").cast("decimal(2,1)")
        return later.select(
            F.when(key % 97 != 0, F.col("sku")).alias("sku"),
            "brandname",
            F.when(key % 3 == 0, _text("Later ", F.col("skudesc"))).otherwise(F.col("skudesc")).alias("skudesc"),
            F.when(key % 3 == 1, raised).otherwise(F.col("wholesale_price")).cast("decimal(18,4)").alias("wholesale_price"),
        )

    def _sized_products(self, condition: str, changed: bool) -> DataFrame:
        key = F.col("p_partkey")
        price = money("p_retailprice") * F.lit("0.5").cast("decimal(2,1)")
        desc = F.when(key % 37 != 0, F.col("p_name"))
        if changed:
            raised = F.lit("1.1").cast("decimal(2,1)")
            price = F.when(key % 4 == 0, price * raised).otherwise(price)
            desc = F.when(key % 5 == 0, _text("New ", F.col("p_name"))).otherwise(desc)
        return (
            self.given("part")
            .filter(condition)
            .select(
                part_sku("p_partkey").alias("sku"),
                F.col("p_brand").alias("brandname"),
                desc.alias("skudesc"),
                price.cast("decimal(18,4)").alias("wholesale_price"),
            )
        )

    def sales_lines(
        self, since: dt.date | None = None, arrived_at: Column | None = None
    ) -> DataFrame:
        """Lines by ship date. ``since`` filters the stored timestamp: the scan skips the rest."""
        lines = self.given("lineitem")
        if since is not None:
            lines = lines.filter(F.col("l_shipdate") >= F.lit(since))
        return lines.select(
            F.to_date("l_shipdate").alias("fact_date"),
            F.col("l_suppkey").alias("location_id"),
            part_sku("l_partkey").alias("sku"),
            F.col("l_quantity").cast("bigint").alias("units"),
            money("l_extendedprice").alias("value"),
            "l_returnflag",
            (F.col("l_partkey") % 100).alias("style"),
            *([] if arrived_at is None else [arrived_at.alias("arrived_at")]),
        )

    @cached_property
    def last_date(self) -> dt.date:
        """The largest ship date of the data."""
        return self.given("lineitem").agg(F.max("l_shipdate")).first()[0].date()
