"""Small helpers shared by the operators of this subpackage."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.session import scratch_path

# Rows of one Arrow batch. Texts of 100,000 characters then make 25 MB at most
# in a Python worker, instead of the default's 1 GB.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark has to open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, the
    copy outlives executors, and its size is known when later joins are planned."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_map(spark: SparkSession, schema: str, make):
    """A pandas UDF over one column that returns a struct of ``schema``.

    ``make()`` runs once in a task and returns a function from a value (None for a
    null text) to a tuple in the order of ``schema``; its caches live as long as the
    task. The UDF sees only that column, so ids, nulls in them and columns of
    any name stay on the JVM side.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = make()
        for texts in batches:
            rows = [one(None if isinstance(t, float) else t) for t in texts]  # pandas may make a null a NaN
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(names, columns)}, columns=names)

    return F.pandas_udf(run, schema)


def applied(df: DataFrame, udf, text: str | Column, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``df`` and the fields of ``udf(text)``."""
    result = fresh(df, "result")
    return df.select(*keep, udf(F.col(text) if isinstance(text, str) else text).alias(result)).select(
        *keep, f"{result}.*"
    )
