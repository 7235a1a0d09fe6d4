"""Plain file formats and the files of a training run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.operators.evaluate import EPOCH_COLUMNS


def write_csv(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", "true").csv(folder)


def read_csv(
    spark: SparkSession, folder: str, schema: T.StructType | str | None = None, *, parse_dates: bool = False
) -> DataFrame:
    """With a schema nothing is guessed. Without one, types are inferred, and timestamps only on request."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        return reader.schema(schema).csv(folder)
    inferred = reader.option("inferSchema", "true").option("preferDate", str(parse_dates).lower()).csv(folder)
    if parse_dates:
        return inferred
    return inferred.select(
        *(
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
            else F.col(f.name)
            for f in inferred.schema.fields
        )
    )


def write_json(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(folder)


def read_json(spark: SparkSession, folder: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(folder)


def write_parquet(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(folder)


def read_parquet(spark: SparkSession, *folders: str) -> DataFrame:
    return spark.read.parquet(*folders)


# --- training runs --------------------------------------------------------------------------------------


def append_epochs(epochs: DataFrame, folder: str) -> None:
    """Epoch rows ``(run, ...)`` as CSV, one folder per run; each call adds what it is given."""
    epochs.write.mode("append").partitionBy("run").option("header", "true").csv(folder)


def read_epochs(spark: SparkSession, folder: str, columns: str = EPOCH_COLUMNS) -> DataFrame:
    return spark.read.option("header", "true").schema(f"{columns}, run int").csv(folder)


def write_runs(summaries: DataFrame, folder: str) -> None:
    """Run summaries as JSON, replaced as a whole."""
    summaries.write.mode("overwrite").json(folder)


def append_run_manifest(runs: DataFrame, folder: str) -> None:
    """Parameters and results of runs, one CSV row each."""
    runs.write.mode("append").option("header", "true").csv(folder)
