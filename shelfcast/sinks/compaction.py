"""A history of runs whose small old files are packed into larger ones.

A run is written to a folder of its own, with its run id as a column. A stored layout says which
folder holds which run; a catalog table shows the latest layout, and is pointed at the next one once
everything the next one names is written. A reader sees each run once: from its own folder before a
compaction, from the packed one after. A run or a compaction that breaks off leaves folders that no
layout names.

A compaction takes all folders whose files are small, whatever runs they hold, except those of the
newest runs. Their rows are dealt to files of equal numbers of rows in the order of the runs, so a
run that is larger than a file is split and many small runs share one, and a filter on the run id
skips files by their statistics. The driver sees the layout, one row per run, and rows are joined to
it by a broadcast: dealt out by run, a large run would be one task's. One writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfcast.sinks.publish import publish_pointed, publish_table

LAYOUT = "run_id string, seq bigint, folder string, files bigint, bytes bigint"
AT = "_history_folder"
RUN_ID = "run_id"
PLACES = 1 << 20  # parts of a run that are told apart when its rows are dealt to files


@dataclass(frozen=True)
class PackedHistory:
    """Runs with the columns of ``schema`` under ``base``; ``name`` is the layout's catalog table."""

    base: str
    schema: StructType
    name: str

    def layout(self, spark: SparkSession) -> list[Row]:
        """Rows (run_id, seq, folder, files, bytes) by seq, the order in which runs were added;
        files and bytes are those of the whole folder."""
        if not spark.catalog.tableExists(self.name):
            return []
        return sorted(spark.table(self.name).collect(), key=lambda r: r.seq)

    def _columns(self) -> list[str]:
        return [*[f"`{f.name}`" for f in self.schema.fields], RUN_ID]

    def _stored(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        """The rows of folders, with the folder of each."""
        with_run = StructType([*self.schema.fields, StructField(RUN_ID, StringType())])
        if not folders:
            return spark.createDataFrame([], with_run).withColumn(AT, F.lit(""))
        rows = spark.read.schema(with_run).parquet(*[f"{self.base}/{f}" for f in folders])
        folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
        return rows.select("*", folder.alias(AT))

    def _write(self, df: DataFrame) -> tuple[str, int, int]:
        """Write a new folder; its name, files and bytes."""
        folder = f"folder-{uuid.uuid4().hex}"
        path = publish_table(df, self.base, folder)
        files = df.sparkSession.read.schema(df.schema).parquet(path)
        files = files.groupBy("_metadata.file_path").agg(F.first("_metadata.file_size").alias("size"))
        n, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        return folder, max(1, n), size  # a folder without rows has one file too

    def _show(self, spark: SparkSession, layout: list[tuple]) -> None:
        rows = spark.createDataFrame(layout, LAYOUT).coalesce(1)
        publish_pointed(rows, self.name, f"{self.base}/layouts", uuid.uuid4().hex)

    def append(self, df: DataFrame, run_id: str) -> None:
        """Add a run, or replace it if it is there, also if it has been packed and now has no rows."""
        spark, before = df.sparkSession, self.layout(df.sparkSession)
        folder, files, size = self._write(df.withColumn(RUN_ID, F.lit(run_id)).select(*self._columns()))
        seq = max((r.seq for r in before), default=-1) + 1
        kept = [tuple(r) for r in before if r.run_id != run_id]
        self._show(spark, [*kept, (run_id, seq, folder, files, size)])

    def read(self, spark: SparkSession) -> DataFrame:
        """All runs' rows with their run id: the rows of the layout's folders, but for runs that have
        been written again to another folder since."""
        layout = self.layout(spark)
        rows = self._stored(spark, sorted({r.folder for r in layout}))
        named = spark.createDataFrame([(r.run_id, r.folder) for r in layout], f"run_id string, {AT} string")
        return rows.join(F.broadcast(named), [RUN_ID, AT], "left_semi").select(*self._columns())

    def compact(self, spark: SparkSession, target_bytes: int, recent: int = 1) -> list[str]:
        """Pack what lies in files of under half of target_bytes on average into files of about
        target_bytes, except the ``recent`` newest runs; return the runs that moved.

        Afterwards the files of older runs are at most one more than twice their bytes would fill.
        """
        layout = self.layout(spark)
        old = layout[: max(0, len(layout) - recent)]
        held = {r.folder for r in layout[len(old) :]}
        packed = [r for r in old if r.folder not in held and r.bytes < r.files * target_bytes / 2]
        folders = {r.folder: r for r in packed}
        if sum(r.files for r in folders.values()) < 2:
            return []
        n_files = max(1, sum(r.bytes for r in folders.values()) // target_bytes)
        rows = self._stored(spark, sorted(folders))
        named = spark.createDataFrame(
            [(r.run_id, r.folder, r.seq) for r in packed], f"run_id string, {AT} string, _seq bigint"
        )
        counts = rows.groupBy(RUN_ID, AT).agg(F.count("*").alias("_n")).join(F.broadcast(named), [RUN_ID, AT])
        until = F.sum("_n").over(Window.orderBy("_seq"))  # one row per run
        shares = counts.select(
            RUN_ID,
            AT,
            (until - F.col("_n")).alias("_before"),
            "_n",
            F.sum("_n").over(Window.partitionBy()).alias("_all"),
        )
        part = F.pmod(F.xxhash64("_metadata.file_path", "_metadata.row_index"), F.lit(PLACES)) / PLACES
        place = (F.col("_before") + F.col("_part") * F.col("_n")) * n_files / F.col("_all")
        dealt = (
            rows.select("*", part.alias("_part"))
            .join(F.broadcast(shares), [RUN_ID, AT])
            .withColumn("_file", F.least(F.floor(place), F.lit(n_files - 1)).cast("int"))
            .repartitionById(n_files, F.col("_file"))
            .sortWithinPartitions(RUN_ID)
            .select(*self._columns())
        )
        folder, files, size = self._write(dealt)
        moved = {r.run_id for r in packed}
        kept = [tuple(r) for r in layout if r.run_id not in moved]
        self._show(spark, [*kept, *[(r.run_id, r.seq, folder, files, size) for r in packed]])
        return [r.run_id for r in packed]
