"""Tables: parquet shards, guarded writes, appends with generated keys, JDBC, quadtrees and their manifest."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quadrille.operators.quadtree import ACTIVE, active_cells, describe_cells
from quadrille.plans.asof import searched
from quadrille.plans.ranking import keyed_index, running_total
from quadrille.plans.sizing import broadcast_if_small, row_bytes
from quadrille.sources.reserve import reserve, reserved_until

#: Bytes of rows per file and writing task, before encoding; a larger shard is several files in its folder.
FILE_BYTES = 256 * 1024 * 1024
#: Folders of reservations inside a table's folder; readers skip names with an underscore.
_IDS, _SEQUENCE = "_ids", "_sequence"


# --- parquet shards -------------------------------------------------------------------------------------


def write_shards(
    rows: DataFrame, folder: str, *, delete_existing: bool = False, rows_per_file: int | None = None, file_bytes: int = FILE_BYTES
) -> None:
    """Rows ``(id, shard, pos, ...)`` as parquet, one folder ``shard=<name>`` per shard, sorted by id inside a file.

    Files are cut by bytes: a task writes ``file_bytes`` of rows and less than one row more, be that many small shards or a piece of a
    large one. ``rows_per_file`` cuts shards by positions instead. ``rows`` is read twice and must give the same rows.
    """
    if rows_per_file is not None:
        placed = rows.repartition(F.col("shard"), F.expr(f"pos div {rows_per_file}"))
    else:
        placed = _dealt_by_bytes(rows, file_bytes)
    guarded_write(placed.sortWithinPartitions("shard", "id"), folder, delete_existing=delete_existing, partition_by=["shard"])


def _dealt_by_bytes(rows: DataFrame, file_bytes: int) -> DataFrame:
    """One partition per ``file_bytes`` of the rows in the order of shard and position.

    Only shard, position and size are sorted. What comes back is where the pieces of each shard begin, an array per shard, in
    which a row finds its piece by a binary search; the rows themselves are moved once.
    """
    narrow = rows.select("shard", "pos", row_bytes(rows).alias("_bytes"))
    upto = running_total(narrow, ["shard", "pos"], "_bytes", "_upto")
    pieces = upto.groupBy("shard", F.expr(f"cast((_upto - 1) div {file_bytes} as int)").alias("_file")).agg(F.min("pos").alias("_from"))
    starts = pieces.groupBy(F.col("shard").alias("_of")).agg(F.sort_array(F.collect_list(F.struct("_from", "_file"))).alias("_starts"))
    longest, last = starts.agg(F.max(F.size("_starts")), F.max(F.expr("array_max(_starts._file)"))).first()
    if last is None:
        return rows
    # A shard without a name is one too.
    met = rows.join(broadcast_if_small(starts), F.col("shard").eqNullSafe(F.col("_of"))).withColumn("_key", F.col("pos").cast("long"))
    placed = searched(met, "_at", F.col("_starts._from"), longest)
    return placed.withColumn("_task", F.get("_starts._file", F.col("_at") - 1)).repartitionById(last + 1, "_task").select(*rows.columns)


def guarded_write(
    df: DataFrame, folder: str, *, delete_existing: bool = False, partition_by: list[str] | None = None
) -> None:
    """Fails when the target has data, unless it is to be replaced."""
    writer = df.write.mode("overwrite" if delete_existing else "errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)


def read_shard_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def shard_counts(table: DataFrame) -> DataFrame:
    """``(shard, n)`` of a written table, the input of a catalog rebuild."""
    return table.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


# --- appends --------------------------------------------------------------------------------------------


def next_id(spark: SparkSession, folder: str) -> int:
    """Key after the greatest one in the table or reserved by a writer; 1 for a table that does not exist yet."""
    until = reserved_until(spark, f"{folder}/{_IDS}")
    return _after_last(spark, folder) if until is None else until


def _after_last(spark: SparkSession, folder: str) -> int:
    table = _existing(spark, folder)
    return 1 if table is None else (table.agg(F.max("id")).first()[0] or 0) + 1


def _existing(spark: SparkSession, folder: str) -> DataFrame | None:
    """The table, or None where there is no such folder or only reservations in it; any other trouble is an error."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as problem:
        missing = problem.getCondition() == "PATH_NOT_FOUND"
        if missing or (problem.getCondition() == "UNABLE_TO_INFER_SCHEMA" and reserved_until(spark, f"{folder}/{_IDS}") is not None):
            return None
        raise


def _reserved(spark: SparkSession, folder: str, count: int) -> int:
    """First of ``count`` keys for one writer; tables from before reservations go on after their greatest key."""
    if not count:
        return 0
    return reserve(spark, f"{folder}/{_IDS}", count, lambda: _after_last(spark, folder))


def append_rows(df: DataFrame, folder: str, order_by: list[str]) -> None:
    """Appends id-less rows; ids continue after the last reserved one of the table, in the given order.

    Several writers may append at once: each reserves as many ids as it has rows before it writes. ``df`` must give the same rows each
    time it is read. A writer that fails after its reservation leaves a gap.
    """
    start = _reserved(df.sparkSession, folder, df.count())
    shared_append(keyed_index(df.drop("id"), order_by, "id", start), folder)


def copy_table(source: DataFrame, folder: str, order_by: list[str] | None = None) -> None:
    """Copies every row without its id; the target numbers them anew in the order of the old ids."""
    start = _reserved(source.sparkSession, folder, source.count())
    numbered = keyed_index(source.withColumnRenamed("id", "_old"), order_by or ["_old"], "id", start)
    shared_append(numbered.drop("_old"), folder)


def shared_append(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> None:
    """Appends while others append: Spark's own append shares one temporary folder per table, which the first to finish deletes.

    Files are written to a folder of their own that readers skip and are then moved, one rename a file, as Spark's commit does too.
    A writer that dies while it moves leaves some of its files in the table.
    """
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    staging = f"{folder}/_staging-{uuid.uuid4().hex}"
    store = path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(staging)
        root = store.makeQualified(path(staging)).toUri()
        found = store.listFiles(path(staging), True)
        while found.hasNext():
            file = found.next().getPath()
            if file.getName().startswith(("_", ".")):
                continue
            target = path(path(folder), path(root.relativize(file.toUri()).getPath()))
            store.mkdirs(target.getParent())
            if not store.rename(file, target):
                raise OSError(f"{file} could not be moved to {target}")
    finally:
        store.delete(path(staging), True)


def read_query(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """A parametric query over registered views; values are bound, not pasted."""
    return spark.sql(text, args=dict(args or {}))


def jdbc_options(
    url: str, table: str, *, low: int, high: int, partitions: int, column: str = "id", **extra: str
) -> dict[str, str]:
    """Options of a range-partitioned read of ``low <= id <= high``. The bounds only place the cuts; no row is lost."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(partitions),
        **extra,
    }


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def append_jdbc(df: DataFrame, url: str, table: str, **extra: str) -> None:
    """Appends to a database table that generates its own key."""
    df.drop("id").write.format("jdbc").options(url=url, dbtable=table, **extra).mode("append").save()


# --- quadtrees ------------------------------------------------------------------------------------------


def save_cells(cells: DataFrame, folder: str) -> None:
    """Stores ``(cell, state, n)``; all else follows from the path."""
    cells.select("cell", "state", "n").write.mode("errorifexists").parquet(folder)


def load_cells(spark: SparkSession, folder: str) -> DataFrame:
    return describe_cells(spark.read.parquet(folder))


def load_active_cells(spark: SparkSession, folder: str) -> DataFrame:
    """``(class_idx, cell, n)`` of a stored quadtree."""
    return active_cells(load_cells(spark, folder).where(F.col("state") == ACTIVE))


def quadtree_name(tau_min: int, tau_max: int, fraction: float) -> str:
    return f"qt_min{tau_min}_max{tau_max}_df{int(fraction * 100)}pct"


def append_manifest(
    folder: str,
    *,
    name: str,
    tau_min: int,
    tau_max: int,
    max_id: int,
    summary: DataFrame,
    excluded: DataFrame,
) -> None:
    """Adds a quadtree to the manifest; its excluded ids go to a table of their own. Several writers may add at once.

    ``summary`` is the one row of the partition summary, ``excluded`` is ``(id)``.
    """
    spark = summary.sparkSession

    def first() -> int:
        entries = _existing(spark, f"{folder}/entries")
        return 1 if entries is None else (entries.agg(F.max("seq")).first()[0] or 0) + 1

    seq = reserve(spark, f"{folder}/{_SEQUENCE}", 1, first)
    entry = summary.select(
        F.lit(name).alias("name"),
        F.struct(
            F.lit(tau_min).alias("tau_min"), F.lit(tau_max).alias("tau_max"), F.lit(max_id).cast("long").alias("max_id")
        ).alias("params"),
        F.struct("max_depth", "active_cells", "excluded_data_points").alias("stats"),
        F.lit(seq).cast("long").alias("seq"),
    )
    ids = excluded.select("id", F.lit(name).alias("quadtree"), F.lit(seq).cast("long").alias("seq"))
    shared_append(ids, f"{folder}/excluded", ["quadtree", "seq"])
    shared_append(entry, f"{folder}/entries")


def manifest_entry(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The entry of a name that was added last."""
    entries = spark.read.parquet(f"{folder}/entries").where(F.col("name") == name)
    return entries.orderBy(F.desc("seq")).limit(1)


def manifest_excluded(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``(id)`` excluded by the latest entry of a name, from its partition alone."""
    entry = manifest_entry(spark, folder, name).select("name", "seq").first()
    ids = spark.read.parquet(f"{folder}/excluded")
    if entry is None:
        return ids.select("id").limit(0)
    return ids.where((F.col("quadtree") == entry["name"]) & (F.col("seq") == entry["seq"])).select("id")


def latest_entries(entries: DataFrame) -> DataFrame:
    """The last entry of every name, from a table of entries."""
    last = entries.groupBy("name").agg(F.max("seq").alias("seq"))
    return entries.join(broadcast_if_small(last), ["name", "seq"], "left_semi")
