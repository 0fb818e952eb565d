"""What both vector searches share: usable vectors, copies of a vector, the ranked result.

Copies of one vector form a class, named by its smallest vec_id. Only the k + 1 smallest ids of a
class can be among anyone's k nearest, so searches run over classes and keep no more members; this
drops no possible result. A repeated row is a candidate of its own, only the query's own row is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import ship_code, stored


def usable(vectors: DataFrame, zero_too: bool) -> DataFrame:
    """Rows (vec_id, vec array<double>) with an id whose vector has components that are all finite,
    not all zero unless zero_too, and as many as most vectors have (the larger number of equals)."""
    ship_code(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & finite)
    if not zero_too:
        rows = rows.where(F.exists("vec", lambda x: x != 0))
    dims = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vec") == (dims["d"] if dims else 0))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """Stored rows (class, vec, vec_id, copy): the k + 1 smallest ids of each class; copy numbers
    repeated rows of one id from 1."""
    by_id = Window.partitionBy("vec").orderBy("vec_id")
    members = (
        rows.withColumn("rn", F.row_number().over(by_id))
        .where(F.col("rn") <= k + 1)
        .withColumn("class", F.min("vec_id").over(Window.partitionBy("vec")))
    )
    copy = F.row_number().over(Window.partitionBy("class", "vec_id").orderBy("rn"))
    return stored(members.select("class", "vec", "vec_id", copy.alias("copy")), "classes")


def query_rows(rows: DataFrame, members: DataFrame, is_query: Column) -> DataFrame:
    """Stored rows (query_id, class), one for each query row."""
    heads = members.where("vec_id = class AND copy = 1").select("class", "vec")
    asked = rows.where(is_query).join(heads, "vec").select(F.col("vec_id").alias("query_id"), "class")
    return stored(asked, "queries")


def nearest(found: DataFrame, queries: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) from found (qclass, class, score), which holds the
    k + 1 best classes of each query's class at least, each once."""
    order = [F.desc("score"), "vec_id", "copy"]
    candidates = (
        found.join(members.select("class", "vec_id", "copy"), "class")
        .withColumn("rn", F.row_number().over(Window.partitionBy("qclass").orderBy(*order)))
        .where(F.col("rn") <= k + 1)
        .select("qclass", "class", "vec_id", "copy", "score")
    )
    own_row = (F.col("vec_id") == F.col("query_id")) & (F.col("class") == F.col("qclass")) & (F.col("copy") == 1)
    asked = queries.withColumnRenamed("class", "qclass")
    number = F.row_number().over(Window.partitionBy("query_id", "qclass").orderBy(F.lit(1)))
    asked = asked.withColumn("again", number)
    best = Window.partitionBy("query_id", "qclass", "again").orderBy(*order)
    return (
        asked.join(candidates, "qclass")
        .where(~own_row)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
