"""Rejected rows per feed and the alert on them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeedCheck:
    """A feed, its key (unique unless said otherwise) and, per reference column, a one-column frame
    of known values."""

    name: str
    rows: DataFrame
    key: Sequence[str]
    dimensions: Mapping[str, DataFrame] = field(default_factory=dict)
    unique: bool = True


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def feed_rejects(feed: FeedCheck) -> DataFrame:
    """One row: feed name and how many of its rows are rejected.

    A row is rejected, once, when a key or reference column is NULL, when a reference is not in its
    dimension, or when its unique key occurs more than once. Our own definition: only the summary's
    columns are known. Each reference's distinct values are compared with its dimension first; what
    the rows are joined to is the values found unknown, usually few or none.
    """
    columns = list(dict.fromkeys([*feed.key, *feed.dimensions]))
    # the values to look up come from the groups, which are fewer than the rows
    counted = feed.rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    bad = [F.col(c).isNull() for c in columns]
    for i, (column, dimension) in enumerate(feed.dimensions.items()):
        unknown = (
            counted.select(column)
            .distinct()
            .join(dimension.toDF(column), column, "left_anti")
            .withColumn(f"unknown_{i}", F.lit(True))
        )
        counted = counted.join(unknown, column, "left")
        bad.append(F.col(f"unknown_{i}").isNotNull())
    per_key = (
        counted.withColumn("n_bad", F.when(_any(bad), F.col("n")).otherwise(0))
        .groupBy(*feed.key)
        .agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"))
    )
    repeated = (F.col("n") > 1) & F.lit(feed.unique)
    rejected = F.when(repeated, F.col("n")).otherwise(F.col("n_bad"))
    return per_key.agg(F.coalesce(F.sum(rejected), F.lit(0)).alias("reject_count")).select(
        F.lit(feed.name).alias("interface_name"), "reject_count"
    )


def reject_rules(feed: FeedCheck) -> list[str]:
    """The rules that a row of the feed can fail, in the order of their bits."""
    return ["unknown_key", *[f"not_in_{c}" for c in feed.dimensions], *(["repeated_key"] if feed.unique else [])]


def labelled_rows(feed: FeedCheck) -> DataFrame:
    """The rows of a feed with ``reject_bits``: bit i is set where ``reject_rules(feed)[i]`` fails, and
    none where the row is accepted. The rows with a bit are those that ``feed_rejects`` counts.

    Rows are joined to what is wrong, which is usually little: values not in their dimension, and
    keys that occur more than once. A key that occurs in a third of all rows is one row there, and
    the rows stay on the left, where AQE splits them. A NULL key fails as unknown, not as repeated.
    """
    rows = feed.rows
    columns = list(dict.fromkeys([*feed.key, *feed.dimensions]))
    rules = reject_rules(feed)
    failed = [_any([F.col(c).isNull() for c in columns])]
    for i, (column, dimension) in enumerate(feed.dimensions.items()):
        name = f"reject_{i}"
        unknown = rows.select(column).distinct().join(dimension.toDF(column), column, "left_anti")
        rows = rows.join(unknown.where(F.col(column).isNotNull()).withColumn(name, F.lit(True)), column, "left")
        failed.append(F.col(name).isNotNull())
    if feed.unique:
        counted = feed.rows.groupBy(*feed.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = rows.join(counted.drop("n").withColumn("reject_n", F.lit(True)), list(feed.key), "left")
        failed.append(F.col("reject_n").isNotNull())
    bits = reduce(
        lambda a, b: a + b, [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed)]
    )
    if len(failed) != len(rules):
        raise AssertionError("a bit for each rule")
    return rows.select(*[F.col(c) for c in feed.rows.columns], bits.alias("reject_bits"))


def rejects_by_rule(feed: FeedCheck, labelled: DataFrame) -> DataFrame:
    """Rows (interface_name, rule, reject_count) with how many labelled rows fail each rule; a row
    that fails two is counted under both."""
    bits = F.col("reject_bits")
    counts = labelled.agg(
        *[F.count(F.when(bits.bitwiseAND(1 << i) != 0, 1)).alias(rule) for i, rule in enumerate(reject_rules(feed))]
    )
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("reject_count")) for r in reject_rules(feed)])
    return counts.select(F.lit(feed.name).alias("interface_name"), F.inline(pairs))


def reject_summary(feeds: Iterable[FeedCheck]) -> DataFrame:
    return reduce(DataFrame.unionByName, [feed_rejects(feed) for feed in feeds])


def rejected_feeds(summary: DataFrame) -> DataFrame:
    """Names of feeds with rejected rows."""
    return summary.filter(F.col("reject_count") > 0).select("interface_name")


def is_clean(summary: DataFrame) -> bool:
    return rejected_feeds(summary).isEmpty()
