"""Re-ingest on arrival: every new export dropped into a landing folder
rebuilds the derived layers (the upload path of the surveyed service).

A ``binaryFile`` stream over the landing folder yields one row per new file;
only ``path`` is selected, so file contents are never read by the stream
itself (the content column is pruned). Each micro-batch runs the batch job on
its new exports; the stream's checkpoint records which files are done, so a
restarted driver neither skips nor repeats an export.

An export that cannot be read does not stop the others: it is tried again, and if it fails
each time a row of the failure table says so, as the answer to an upload would.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitals.config import HEALTH, MetricConfig

log = logging.getLogger("vitals.arrivals")

# The fixed schema of the binaryFile source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
FAILURE_SCHEMA = "path string, length bigint, attempts int, error string, batch bigint"
FILES_PER_BATCH = 64
ENTITIES_AT_ONCE = 4
ERROR_LENGTH = 4000  # characters of an error's text that are kept


def arrivals(spark: SparkSession, landing: str, pattern: str = "*.xml", files: int = FILES_PER_BATCH) -> DataFrame:
    """Streaming DataFrame of newly arrived export files, in key folders or not: ``(path, length, modified)``;
    a micro-batch has at most ``files`` of them."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files)
        .load(landing)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def entity_root(root: str, path: str, keys: tuple[str, ...]) -> str:
    """Where the layers of the entity lie whose export is at ``path``:
    ``<root>/user_id=7`` for a file in a folder ``user_id=7``."""
    folders = dict(part.split("=", 1) for part in path.split("/")[:-1] if "=" in part)
    missing = [k for k in keys if k not in folders]
    if missing:
        raise ValueError(f"{path} lies in no folder for {', '.join(missing)}")
    return "/".join([root.rstrip("/"), *(f"{k}={folders[k]}" for k in keys)])


def failures_path(root: str) -> str:
    return f"{root.rstrip('/')}/failures"


def failures(spark: SparkSession, root: str) -> DataFrame:
    """The exports that could not be taken in: path, length, attempts, the last error's text, and the
    micro-batch (empty before the first micro-batch has run)."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(FAILURE_SCHEMA).option("recursiveFileLookup", "true").json(failures_path(root))
    except AnalysisException:
        return spark.createDataFrame([], FAILURE_SCHEMA)


def watch_exports(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    cfg: MetricConfig = HEALTH,
    mode: str = "split",
    trigger: dict | None = None,
    keys: tuple[str, ...] = (),
    files: int = FILES_PER_BATCH,
    attempts: int = 2,
) -> StreamingQuery:
    """Start the stream; each new export rebuilds bronze, silver, gold and the
    report under ``root``, or with ``keys`` under its own entity's folder there, so
    that an upload leaves the other entities alone. ``checkpoint`` keeps the stream's
    progress and has to be the same folder after a restart.

    A micro-batch takes up to ``files`` exports. Of several exports for one place the last one
    stands (by time, then path), as if they had come one by one; a failed one leaves the
    place to the one before it. Different entities are rebuilt side by side. An export
    that fails ``attempts`` times is left with a row in ``failures(spark, root)``. Rows of a
    micro-batch replace each other, so a batch that runs again after a crash leaves no doubles.
    """
    from vitals.plans.jobs import run_export

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        # at most ``files`` rows: the names of the new files
        places: dict[str, list] = {}
        failed = []
        for row in batch.orderBy("modified", "path").collect():
            path = unquote(row["path"]) if "%" in row["path"] else row["path"]
            try:
                places.setdefault(entity_root(root, path, keys) if keys else root, []).append((path, row["length"]))
            except ValueError as e:
                failed.append((path, row["length"], 1, str(e)[:ERROR_LENGTH], batch_id))

        def take(place: str) -> list[tuple]:
            lost = []
            for path, length in reversed(places[place]):
                error = None
                for _ in range(attempts):
                    try:
                        run_export(spark, path, place, cfg, mode)
                        return lost
                    except Exception as e:  # whatever is wrong with this export is told, and the others go on
                        error = f"{type(e).__name__}: {e}"[:ERROR_LENGTH]
                        log.warning("export %s failed: %s", path, error)
                lost.append((path, length, attempts, error, batch_id))
            return lost

        with ThreadPoolExecutor(max_workers=ENTITIES_AT_ONCE) as pool:
            for lost in pool.map(take, places):
                failed += lost
        told = spark.createDataFrame(failed, FAILURE_SCHEMA).coalesce(1)
        told.write.mode("overwrite").json(f"{failures_path(root)}/batch={batch_id}")

    writer = arrivals(spark, landing, files=files).writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return writer.start()
