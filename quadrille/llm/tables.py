"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.plans.durable import fresh_folder


#: Rows of a batch that goes to a Python worker: texts of some thousand characters make a few megabytes, in the worker and beside it.
BATCH_ROWS = 1000
#: Batches for Python workers, and those in which texts are read.
_BATCHES = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of the session, unless they are smaller already. Results do not depend on them."""
    for name in _BATCHES:
        if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
            spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    small_batches(spark)
    folder = fresh_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def read_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number for every row: its file and its place in it, the same in every scan however files are split.

    What is not a plain scan of files is stored first.
    """
    small_batches(docs.sparkSession)
    path, place, file, at = (fresh_name(docs, c) for c in ("_path", "_place", "_file", "_at"))
    where = [F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place)]
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("a column hides the metadata")
        places = docs.select("*", *where)
    except AnalysisException:
        docs = stored(docs.withColumnRenamed("_metadata", at) if "_metadata" in docs.columns else docs, "rows")
        places = docs.select("*", *where)
    paths = sorted(r[0] for r in places.select(path).distinct().collect())  # a row per file
    files = docs.sparkSession.createDataFrame(list(zip(paths, range(len(paths)))), f"{path} string, {file} long")
    places = places.join(F.broadcast(files), path)
    names = [F.col(at).alias("_metadata") if c == at else F.col(f"`{c}`") for c in docs.columns]
    return places.select(*names, (F.shiftleft(file, 40) + F.col(place)).alias(name))


def fresh_name(docs: DataFrame, base: str) -> str:
    """A column name that ``docs`` does not have, whatever the case of letters."""
    taken = {c.lower() for c in docs.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, the measure for the number of fragments and shards."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
