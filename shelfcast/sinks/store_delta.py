"""Per-store delta files in one partitioned write."""

from __future__ import annotations

import datetime as dt
import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import sequence_label
from shelfcast.session import held_settings
from shelfcast.sinks.feeds import FEED_OPTIONS, run_stamp

# Hadoop starts a process for each file and folder it makes in a local or mounted folder, to set its mode,
# which takes far longer than to write a store's rows. There the tasks make the stores' files themselves.
# Where a path leads to such a folder by another file system, the hidden checksum files are left out.
PLAIN_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}
TASKS_PER_CORE = 4
NO_STORE = "__HIVE_DEFAULT_PARTITION__"


def export_store_deltas(
    delta: DataFrame, root: str, prefix: str, run_ts: dt.datetime, sequence: int
) -> str:
    """Write each store's rows under a folder named prefix + store + run stamp + sequence.

    A store without rows gets no folder. The rebalance hint lets AQE split a very large store over
    several tasks (and files) and pack small stores together, so no store is one task's burden. A
    small store's file takes as long to make as any, however few its bytes, so the stores are dealt
    to several tasks a core. Rows are formatted by Spark wherever the files lie.
    """
    spark = delta.sparkSession
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    name = F.concat(
        F.lit(prefix),
        F.col("store_id").cast("string"),
        F.lit(run_stamp(run_ts)),
        F.lit("_DELTA_"),
        sequence_label(F.lit(sequence)),
    )
    rows = delta.hint("rebalance", "store_id").withColumn("feed_file", name)
    place = mounted_folder(spark, root)
    with held_settings(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionNum": str(tasks)}):
        if place:
            _write_mounted(rows, delta.columns, *place)
        else:
            (
                rows.write.options(**FEED_OPTIONS)
                .options(**PLAIN_FILES)
                .mode("overwrite")
                .partitionBy("feed_file")
                .csv(root)
            )
    return root


def mounted_folder(spark: SparkSession, root: str) -> tuple[str, int] | None:
    """The path that root has for every program and the umask Hadoop would use there; None where only
    Hadoop reaches it."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    path = re.fullmatch("(file:|file://)?(/(?!/).*)", root.rstrip("/"))
    umask = hadoop.get("fs.permissions.umask-mode", "022")
    if not path or not re.fullmatch("[0-7]+", umask):
        return None
    if not path[1] and not hadoop.get("fs.defaultFS", "file:///").startswith("file:"):
        return None
    return path[2], int(umask, 8)


def _write_mounted(rows: DataFrame, columns: list[str], root: str, umask: int) -> None:
    """The files of all tasks are made in a folder beside root, which takes root's place by its name
    once they are whole: a run that fails leaves root as it was."""
    spark = rows.sparkSession
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), FEED_OPTIONS)
    names = F.to_csv(F.struct(*[F.lit(c).alias(c) for c in columns]), FEED_OPTIONS)
    header = f"{spark.range(1).select(names).first()[0]}\n".encode()
    run = uuid.uuid4().hex
    work = f"{os.path.dirname(root)}/_{os.path.basename(root)}-{run}"
    stores = f"{work}/stores"
    os.makedirs(stores)
    try:
        (
            rows.sortWithinPartitions("store_id")
            .select(F.coalesce("feed_file", F.lit(NO_STORE)), F.concat(line, F.lit("\n")))
            .mapInArrow(_writer(work, stores, run, header, umask), "files bigint")
            .write.format("noop")
            .mode("overwrite")
            .save()
        )
        open(f"{stores}/_SUCCESS", "wb").close()
        os.chmod(f"{stores}/_SUCCESS", 0o666 & ~umask)
        os.chmod(stores, 0o777 & ~umask)
        if os.path.lexists(root):
            shutil.rmtree(root)
        os.rename(stores, root)
    finally:
        shutil.rmtree(work, ignore_errors=True)


def _writer(
    work: str, stores: str, run: str, header: bytes, umask: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a task: it gets the name of a store's folder and a line for each row, a store's
    rows one after the other, and has one file open at a time.

    A file gets its place and name when it is whole. The name holds the partition, not the attempt,
    so an attempt that repeats another takes its files' place. Nothing here refers to this package,
    which the executors need not have.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        file_name = f"part-{task.partitionId():05d}-{run}.csv"
        unfinished = f"{work}/{task.partitionId()}-{task.taskAttemptId()}"
        store, out, files = None, None, 0

        def finish() -> None:
            out.close()
            # characters that Spark escapes in the name of a partition's folder
            escaped = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda c: f"%{ord(c[0]):02X}", store)
            folder = f"{stores}/feed_file={escaped}"
            try:
                os.mkdir(folder)
                os.chmod(folder, 0o777 & ~umask)
            except FileExistsError:
                pass
            os.replace(unfinished, f"{folder}/{file_name}")

        for batch in batches:
            if not batch.num_rows:
                continue
            lines = batch.column(1).cast(pa.large_binary())
            ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            text = memoryview(lines.buffers()[2] or b"")
            runs = pc.run_end_encode(batch.column(0))
            first = 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if name != store:
                    if out:
                        finish()
                    store, out, files = name, open(unfinished, "wb"), files + 1
                    os.fchmod(out.fileno(), 0o666 & ~umask)
                    out.write(header)
                out.write(text[ends[first] : ends[end]])
                first = end
        if out:
            finish()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    return write
