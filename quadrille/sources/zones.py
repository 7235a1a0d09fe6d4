"""Zone maps: which files of a table hold which ids, so that a batch of ids opens no other file.

A zone is what one file holds of ``span`` neighbouring ids (one id bucket): least id, greatest id, number of different ids. Where as many
ids as the interval has room for are there, the zone is full and tells exactly whether an id is in the file; otherwise it
only tells that it may be. The map of a table is kept in its folder under a name that readers skip, is made from the id column alone, and is
carried on for files that were added since.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.plans.sizing import broadcast_if_small

#: Ids of a bucket.
SPAN = 65_536
#: Files that are named in the filter of a scan; where more hold wanted ids, a batch is no small part of the table.
NAMED_FILES = 10_000
_FOLDER = "_zones"
_SCHEMA = "file string, span long, bucket long, low long, high long, ids long"


def zones_of(table: DataFrame, *, key: str = "id", span: int = SPAN) -> DataFrame:
    """``file, span, bucket, low, high, ids`` of a plain scan of files; only ``key`` is read. Rows without a key have no zone."""
    rows = table.where(F.col(key).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.col(key).cast("long").alias("_id"))
    # Each id of a file once: a repeated id must not pass for one that is missing.
    each = rows.groupBy("file", F.floor(F.col("_id") / F.lit(span)).alias("bucket"), "_id").agg(F.count(F.lit(1)))
    zones = each.groupBy("file", "bucket").agg(F.min("_id").alias("low"), F.max("_id").alias("high"), F.count(F.lit(1)).alias("ids"))
    return zones.select("file", F.lit(span).cast("long").alias("span"), "bucket", "low", "high", "ids")


def zone_map(spark: SparkSession, folder: str, *, key: str = "id", span: int = SPAN) -> DataFrame:
    """The zones of the table in ``folder``; files that the stored map does not know are added to it first.

    For one writer at a time. Zones of files that are gone stay and do no harm: no scan finds such a file.
    """
    where, table = f"{folder}/{_FOLDER}/{key}-{span}", spark.read.parquet(folder)
    known = _stored(spark, where)
    names = [r[0] for r in known.select("file").distinct().collect()]  # a name per file, as the driver lists them for any scan
    if {_plain(f) for f in table.inputFiles()} - {_plain(f) for f in names}:
        if len(names) <= NAMED_FILES:
            new = table.where(~F.col("_metadata.file_path").isin(names))
        else:
            path = F.col("_metadata.file_path")
            new = table.join(broadcast_if_small(known.select(F.col("file").alias("_known")).distinct()), path == F.col("_known"), "left_anti")
        zones_of(new, key=key, span=span).write.mode("append").parquet(where)
        known = _stored(spark, where)
    return known


def _plain(path: str) -> str:
    """One spelling of a path: listings and scans differ in slashes and in escapes."""
    return unquote(path).replace(":///", ":/", 1)


def _stored(spark: SparkSession, where: str) -> DataFrame:
    try:
        return spark.read.schema(_SCHEMA).parquet(where)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)


def holding(zones: DataFrame, wanted: DataFrame) -> DataFrame:
    """``file, sure``: files that may hold one of the wanted ``(id)``; ``sure`` where one is held for certain."""
    some = zones.select("span").first()
    span = some.span if some else SPAN
    ids = wanted.select("id").where("id is not null").distinct().withColumn("_bucket", F.floor(F.col("id") / F.lit(span)))
    met = zones.join(broadcast_if_small(ids), (F.col("bucket") == F.col("_bucket")) & F.col("id").between(F.col("low"), F.col("high")))
    return met.groupBy("file").agg(F.bool_or(F.expr("high - low + 1 = ids")).alias("sure"))


def in_files(table: DataFrame, zones: DataFrame, wanted: DataFrame, *, key: str = "id") -> DataFrame:
    """``table`` without the files that hold none of the wanted ids; the ids of the files that stay are still to be met.

    Files of which the map is not certain are asked themselves, by their id column alone. ``table`` is a plain scan of files.
    """
    found = holding(zones, wanted).limit(NAMED_FILES + 1).collect()
    if len(found) > NAMED_FILES:
        return table
    names, doubtful = [r.file for r in found if r.sure], [r.file for r in found if not r.sure]
    if doubtful:
        ids = wanted.select(F.col("id").alias("_id")).distinct()
        asked = table.where(F.col("_metadata.file_path").isin(doubtful)).select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("_key"))
        held = asked.join(broadcast_if_small(ids), F.col("_key") == F.col("_id"), "left_semi").select("file").distinct()
        names += [r.file for r in held.collect()]  # no more than NAMED_FILES
    return table.where(F.col("_metadata.file_path").isin(names))
