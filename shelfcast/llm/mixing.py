"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Documents of a source form blocks of ``block_docs``. A source with weight n of a total of D gives
its block j (from 0) the release time floor(j * D / n) and the deadline ceil((j + 1) * D / n).
Earliest deadline first, among released blocks, fills one slot after another; as the weights add up
to D this meets every deadline, so at any time each source's number of blocks differs from its share
by less than one. The schedule repeats every D slots, so it is made once, for D slots.

Every document gets a slot. Once a source has run out its slots stay empty, and the others go on in
proportion to their weights; nothing is dropped or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stored

#: Rows are numbered by the md5 of their id; its first hexadecimal digits give the slice, so that
#: no source is numbered in one task.
SLICE_DIGITS = 3


def _key(source: Column) -> Column:
    """Sources as not null: the null source comes first and is not the empty one."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def root_weights(docs: DataFrame, resolution: int = 1000) -> DataFrame:
    """Rows (source, weight): weights proportional to the square root of each source's documents, in
    whole parts. There are ``resolution`` parts, or as many more as give the smallest source one of
    them, so that no source has more than its share by more than rounding."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    root, every = F.sqrt("n"), Window.partitionBy()
    total = F.sum(root).over(every)
    needed = F.ceil(F.round(total / F.min(root).over(every), 6))  # sums differ in their last digits
    parts = F.greatest(F.lit(resolution).cast("long"), needed)
    share = F.round(parts * root / total)
    return counts.select("source", F.greatest(share, F.lit(1)).cast("long").alias("weight"))


def schedule(weights: DataFrame) -> DataFrame:
    """One period of the schedule for weights (source, weight > 0): rows (key, turn, slot, weight,
    total), turn counting a source's blocks from 0.

    The sources are gathered into one row: their number and the total weight must be small.
    """
    listed = weights.where("weight > 0").agg(
        F.array_sort(
            F.collect_list(
                F.struct(_key(F.col("source")).alias("key"), F.col("weight").cast("long").alias("n"))
            )
        ).alias("w")
    )
    totals = listed.where("size(w) > 0").withColumn("total", F.expr("aggregate(w, 0L, (a, x) -> a + x.n)"))
    # Slots are filled in stretches, so that only a stretch's picks are copied with each slot. The
    # row is stored, else its list would be sorted and added up again with each slot; the outer
    # explode has no filter, which would make the schedule twice.
    picks = stored(totals.withColumn("step", F.ceil(F.sqrt("total"))), "sources").withColumn(
        "picks",
        F.expr(
            """
            flatten(aggregate(
              sequence(0L, total - 1L, step),
              named_struct('done', transform(w, x -> 0L), 'picks', cast(array() AS array<array<int>>)),
              (before, start) -> transform(
                array(aggregate(
                  sequence(start, least(start + step, total) - 1L),
                  named_struct('done', before.done, 'picks', cast(array() AS array<int>)),
                  (s, t) -> transform(
                    array(
                      array_min(filter(
                        transform(w, (x, i) -> named_struct(
                          'deadline', if(s.done[i] * total div x.n <= t,
                                         ((s.done[i] + 1L) * total + x.n - 1L) div x.n, null),
                          'i', i)),
                        c -> c.deadline IS NOT NULL)).i),
                    p -> named_struct(
                      'done', transform(s.done, (n, i) -> if(i = p, n + 1L, n)),
                      'picks', concat(s.picks, array(p))))[0])),
                s -> named_struct('done', s.done, 'picks', concat(before.picks, array(s.picks))))[0],
              s -> s.picks))
            """
        ),
    )
    slots = picks.select("w", "total", F.posexplode_outer("picks").alias("slot", "i")).select(
        F.expr("w[i].key").alias("key"),
        F.expr("w[i].n").alias("weight"),
        "total",
        F.col("slot").cast("long").alias("slot"),
    )
    turn = F.row_number().over(Window.partitionBy("key").orderBy("slot")) - 1
    return slots.select("key", turn.cast("long").alias("turn"), "slot", "weight", "total")


def mix_slots(docs: DataFrame, weights: DataFrame, block_docs: int, name: str = "mixed") -> DataFrame:
    """docs with a column ``name``: struct of weight, block (of its source, from 0), slot and
    position; positions rise with slots and go through each block in order.

    Inside a source documents follow one another by the md5 of doc_id (null like ''), then doc_id. A
    source without a weight counts as weight 1. All rows and columns stay, repeated rows too; an
    empty table gives no rows. A column of that name is replaced.
    """
    known = weights.select("source", F.greatest(F.col("weight"), F.lit(1)).alias("weight"))
    missing = docs.select(_key(F.col("source")).alias("key"), "source").distinct().join(
        known.select(_key(F.col("source")).alias("key")), "key", "left_anti"
    )
    every = known.unionByName(missing.select("source", F.lit(1).alias("weight")))
    turns = stored(schedule(every), "schedule")
    per_source = turns.groupBy("key").agg(F.first("weight").alias("weight"), F.first("total").alias("total"))

    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        _key(F.col("source")).alias("key"),
        F.md5(id_text).alias("digest"),
        F.substring(F.md5(id_text), 1, SLICE_DIGITS).alias("part"),
    )
    counts = rows.groupBy("key", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    offsets = counts.select("key", "part", before).join(per_source, "key")
    inside = Window.partitionBy("key", "part").orderBy("digest", "doc.doc_id")
    place = F.col("before") + F.row_number().over(inside) - 1
    placed = (
        rows.join(offsets, ["key", "part"])
        .withColumn("place", place)
        .withColumn("block", F.floor(F.col("place") / block_docs))
        .withColumn("turn", F.pmod("block", "weight"))
        .join(turns.select("key", "turn", F.col("slot").alias("at")), ["key", "turn"])
    )
    slot = F.floor(F.col("block") / F.col("weight")) * F.col("total") + F.col("at")
    mixed = F.struct(
        "weight",
        "block",
        slot.alias("slot"),
        (slot * block_docs + F.pmod("place", F.lit(block_docs))).alias("position"),
    )
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c.lower() != name.lower()]
    return placed.select(*kept, mixed.alias(name))
