"""Gold as a set: the tables of a run are written to a folder of their own, and a pointer file
is switched when all of them are there.

A reader that asks for a table is sent to the run that the pointer names, so it never sees
tables of two runs, and a run that dies leaves the pointer alone. The run before the current
one stays for readers that have begun; older ones go.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

POINTER = "_current"


def new_run() -> str:
    """A name for a run; names of later runs come later in text order."""
    return f"run-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _files(spark: SparkSession, path: str):
    """(file system, path) of the Hadoop API for ``path``."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def current_run(layout) -> str | None:
    """The run that readers of ``layout`` see; None before the first one."""
    spark = SparkSession.active()
    files, pointer = _files(spark, f"{layout.gold_dir}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def publish(spark: SparkSession, layout, run: str) -> None:
    """Switch readers of ``layout`` to ``run`` and drop the runs before the last one.

    The pointer is written aside and put in place by one rename.
    """
    before = current_run(layout)
    files, pointer = _files(spark, f"{layout.gold_dir}/{POINTER}")
    _, aside = _files(spark, f"{layout.gold_dir}/.{POINTER}-{run}")
    out = files.create(aside, True)
    out.write(bytearray(run.encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("OVERWRITE")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(pointer).toUri(), conf)
    context.rename(files.makeQualified(aside), files.makeQualified(pointer), options)
    _, folder = _files(spark, layout.gold_dir)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        # a run of a later name may be one that is being written
        if status.isDirectory() and name.startswith("run-") and name < (before or "") and name != run:
            files.delete(status.getPath(), True)
