"""Inputs of the queries, all derived from the driver tables, and the same inputs in SQL."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.scores import softmax
from quadrille.operators.quadtree import active_cells, build_quadtree, leaf_lookup
from quadrille.operators.label import with_cell
from quadrille.plans.durable import pin

TAU_MIN, TAU_MAX, MAX_DEPTH = 10, 200, 19
SHARD_ROWS = 700


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- points ---------------------------------------------------------------------------------------------


def points(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, latitude, longitude)``: seven dense boxes and a thin spread over the globe.

    Squares are taken of the remainder, so that no product overflows on a large table.
    """
    return table(spark, sf, "events").selectExpr(
        "event_id + 1 as id",
        "cast(case when event_id % 4 < 3"
        " then cast((event_id % 7) * 19 - 50 as double)"
        " + cast(((event_id % 4099) * (event_id % 4099) * 31 + (event_id % 4099) * 17) % 4099 as double) / 2048D"
        " else cast((event_id * 7919) % 180000 as double) / 1000D - 90D end as float) as latitude",
        "cast(case when event_id % 4 < 3"
        " then cast((event_id % 7) * 43 - 130 as double)"
        " + cast(((event_id % 4093) * (event_id % 4093) * 13 + (event_id % 4093) * 29) % 4093 as double) / 1024D"
        " else cast((event_id * 104729) % 360000 as double) / 1000D - 180D end as float) as longitude",
    )


POINTS = """points as (select event_id + 1 as id,
  cast(case when event_id % 4 < 3
       then cast((event_id % 7)*19 - 50 as double) + cast((event_id*event_id*31 + event_id*17) % 4099 as double)/cast(2048 as double)
       else cast((event_id*7919) % 180000 as double)/cast(1000 as double) - cast(90 as double) end as real) as latitude,
  cast(case when event_id % 4 < 3
       then cast((event_id % 7)*43 - 130 as double) + cast((event_id*event_id*13 + event_id*29) % 4093 as double)/cast(1024 as double)
       else cast((event_id*104729) % 360000 as double)/cast(1000 as double) - cast(180 as double) end as real) as longitude
from events)"""


def _slot(value: str, low: int, span: int, n: int) -> str:
    guess = f"cast(greatest(least(floor(({value} - ({low}))/{span}*{n}), {n - 1}), 0) as bigint)"
    fixed = (
        f"({guess} + case when {value} < {low} + cast({span} as double)*{guess}/{n} then -1"
        f" when {value} >= {low} + cast({span} as double)*({guess}+1)/{n} then 1 else 0 end)"
    )
    return f"greatest(least({fixed}, {n - 1}), 0)"


def path_sql(depth: int) -> str:
    """Path digits from ``i`` (row from the south) and ``j`` (column from the west)."""
    return " || ".join(
        f"cast((1 - ((i >> {k}) & 1)) * 2 + ((j >> {k}) & 1) as varchar)" for k in range(depth - 1, -1, -1)
    )


def placed_sql(depth: int) -> str:
    n = 2**depth
    return (
        f"""slots as (select id, lat, lon, {_slot('lat', -90, 180, n)} as i, {_slot('lon', -180, 360, n)} as j
  from (select id, cast(latitude as double) as lat, cast(longitude as double) as lon from points)),
placed as (select id, lat, lon, {path_sql(depth)} as path from slots)"""
    )


PLACED = placed_sql(MAX_DEPTH)


def tree_sql(where: str = "true") -> str:
    return f"""prefixes as (select d as depth, substr(path, 1, cast(d as bigint)) as cell, count(*) as n
  from placed, range(1, {MAX_DEPTH + 1}) r(d)
  where lat >= -90 and lat < 90 and lon >= -180 and lon < 180 and {where} group by 1, 2),
opened as (select cell, depth from prefixes where n > {TAU_MIN} and n >= {TAU_MAX} and depth < {MAX_DEPTH}
  union all select '', 0),
nodes as (select o.cell || q.digit as cell, cast(o.depth + 1 as integer) as depth, o.cell as parent,
    cast(coalesce(p.n, 0) as bigint) as n
  from opened o cross join (values ('0'), ('1'), ('2'), ('3')) q(digit)
  left join prefixes p on p.cell = o.cell || q.digit
  union all select '', 0, null, coalesce((select cast(sum(n) as bigint) from prefixes where depth = 1), 0)),
cells as (select cell, depth, parent, cast(case when depth = 0 then 0 when n > {TAU_MIN} and n < {TAU_MAX} then 2
    when n > {TAU_MIN} and n >= {TAU_MAX} and depth = {MAX_DEPTH} then 1 else 0 end as integer) as state, n from nodes),
active as (select cast(row_number() over (order by depth, cell) - 1 as integer) as class_idx, cell, depth, n
  from cells where state = 2)"""


#: Bounds of ``cell`` from its digits.
BOUNDS = """digits as (select cell, length(cell) as d,
    list_sum([cast(substr(cell, k, 1) as bigint) // 2 * (1 << (length(cell) - k)) for k in range(1, length(cell) + 1)]) as r0,
    list_sum([cast(substr(cell, k, 1) as bigint) % 2 * (1 << (length(cell) - k)) for k in range(1, length(cell) + 1)]) as c0
  from cells),
boxes as (select cell, 90 - cast(180 as double) * (coalesce(r0, 0) + 1) / (1 << d) as south,
    90 - cast(180 as double) * coalesce(r0, 0) / (1 << d) as north,
    cast(360 as double) * coalesce(c0, 0) / (1 << d) - 180 as west,
    cast(360 as double) * (coalesce(c0, 0) + 1) / (1 << d) - 180 as east from digits)"""

LABELLED = """labelled as (select p.id, p.lat, p.lon, a.cell, a.class_idx
  from placed p left join (select p2.id, a2.cell, a2.class_idx from placed p2, active a2
    where a2.cell = substr(p2.path, 1, length(a2.cell))) a on a.id = p.id)"""

TREE = f"{POINTS}, {PLACED}, {tree_sql()}"
TREE_BOXES = f"{TREE}, {BOUNDS}"
TREE_LABELS = f"{TREE}, {LABELLED}"


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return build_quadtree(points(spark, sf), TAU_MIN, TAU_MAX, max_depth=MAX_DEPTH)


def classes(tree: DataFrame) -> DataFrame:
    return pin(active_cells(tree))


def labelled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(labelled points, cells, classes)``."""
    tree = cells(spark, sf)
    numbered = classes(tree)
    return with_cell(points(spark, sf), leaf_lookup(tree, numbered)), tree, numbered


def wide(df: DataFrame) -> DataFrame:
    """FLOAT coordinates as DOUBLE for output."""
    return df.select(
        *(F.col(c).cast("double").alias(c) if c in ("latitude", "longitude") else F.col(c) for c in df.columns)
    )


# --- shards ---------------------------------------------------------------------------------------------


def shard_rows(spark: SparkSession, sf: str) -> DataFrame:
    return points(spark, sf).selectExpr(
        f"concat('shard_', cast((id - 1) div {SHARD_ROWS} as string)) as shard",
        f"(id - 1) % {SHARD_ROWS} as pos",
        "latitude",
        "longitude",
    )


SHARD_ROWS_SQL = f"""shard_rows as (select 'shard_' || cast((id - 1) // {SHARD_ROWS} as varchar) as shard,
  (id - 1) // {SHARD_ROWS} as shard_no, (id - 1) % {SHARD_ROWS} as pos, latitude, longitude from points)"""

CATALOG_SQL = """catalog as (select shard as name, shard_no, n as count,
  cast(sum(n) over (order by shard_no) - n as bigint) as min_index, cast(sum(n) over (order by shard_no) - 1 as bigint) as max_index
  from (select shard, shard_no, count(*) as n from shard_rows group by 1, 2))"""


def pack_record(record: dict) -> bytes:
    """One shard record in MessagePack."""
    parts = [bytes([0x80 | len(record)])]
    for name, value in record.items():
        parts.append(bytes([0xA0 | len(name)]) + name.encode())
        if isinstance(value, float):
            parts.append(b"\xcb" + struct.pack(">d", value))
        elif isinstance(value, bytes):
            parts.append(b"\xc6" + struct.pack(">I", len(value)) + value)
        else:
            parts.append(b"\xd9" + bytes([len(value)]) + value.encode())
    return b"".join(parts)


def write_shard_files(rows: DataFrame, folder: str) -> int:
    """Writes ``<folder>/<shard>.msg`` for every shard, one task per group of shards; returns the number of rows."""

    def run(frame):
        from pyarrow import fs

        uri = folder.replace("file:/", "file:///", 1) if "://" not in folder and folder.startswith("file:/") else folder
        system, root = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
        system.create_dir(root, recursive=True)
        name = frame["shard"].iloc[0]
        with system.open_output_stream(f"{root}/{name}.msg") as out:
            for row in frame.sort_values("pos").itertuples(index=False):
                image = f"{row.shard}:{row.pos}".encode()
                out.write(
                    pack_record(
                        {
                            "id": f"{row.shard}/{row.pos}",
                            "image": image,
                            "latitude": float(row.latitude),
                            "longitude": float(row.longitude),
                        }
                    )
                )
        return frame[["shard"]].head(1).assign(n=len(frame))

    # Shards of this input have a fixed number of rows, which bounds a group.
    written = rows.groupBy("shard").applyInPandas(run, "shard string, n long")
    return written.agg(F.sum("n")).first()[0] or 0


# --- requests -------------------------------------------------------------------------------------------


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """``(pos, idx)``: as many requests as points, scattered, with repeats and with some beyond the last id."""
    n = points(spark, sf).count()
    return points(spark, sf).selectExpr("id - 1 as pos", f"(id * 37) % {n + n // 10} as idx")


REQUESTS_SQL = """requests as (select id - 1 as pos, (id * 37) % (t.n + t.n // 10) as idx
  from points, (select count(*) as n from points) t)"""


# --- predictions ----------------------------------------------------------------------------------------


def features(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, features)``, dealt to the shuffle partitions: what is made of a row is wide, and a file may be one row group."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf, "embeddings").selectExpr("vec_id + 1 as id", "embedding as features").repartition(tasks, "id")


def predictions(spark: SparkSession, sf: str, number: int) -> DataFrame:
    """``(id, probs)``: softmax over ``number`` classes of the embedding, repeated as often as needed."""
    return features(spark, sf).select("id", softmax("features", number).alias("probs"))


PREDICTIONS_SQL = """scores as (select vec_id + 1 as id,
    [cast(embedding[cast(i % len(embedding) + 1 as bigint)] as double) for i in range(0, (select count(*) from active))] as s
  from embeddings),
shifted as (select id, [exp(x - list_max(s)) for x in s] as e from scores),
predictions as (select id, [x / list_sum(e) for x in e] as probs from shifted),
flat as (select id, unnest(probs) as prob, cast(generate_subscripts(probs, 1) - 1 as integer) as class_idx from predictions)"""


# --- training history -----------------------------------------------------------------------------------


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Batch log of six runs of twenty epochs."""
    return table(spark, sf, "lineitem").selectExpr(
        "cast(l_suppkey % 6 + 1 as int) as run",
        "cast(l_orderkey % 20 + 1 as int) as epoch",
        "if(l_linenumber % 2 = 0, 'train', 'test') as phase",
        "cast(l_quantity as bigint) as rows",
        "l_extendedprice / 10000D as loss",
        "cast(l_linenumber as bigint) as hits",
        "l_quantity * l_tax as squared_error",
        "l_discount as fetch_seconds",
        "l_tax as model_seconds",
        "cast(l_shipdate as timestamp_ntz) as stamp",
    )


STEPS_SQL = """steps as (select cast(l_suppkey % 6 + 1 as integer) as run, cast(l_orderkey % 20 + 1 as integer) as epoch,
  case when l_linenumber % 2 = 0 then 'train' else 'test' end as phase, cast(l_quantity as bigint) as rows,
  l_extendedprice / 10000 as loss, cast(l_linenumber as bigint) as hits, l_quantity * l_tax as squared_error,
  l_discount as fetch_seconds, l_tax as model_seconds, l_shipdate as stamp from lineitem)"""


def epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch table of the log; run 3 has NaN test losses in every fourth epoch."""
    log = steps(spark, sf)

    def mean(value: str, phase: str) -> str:
        kept = f"case when phase = '{phase}' then rows end"
        return f"round(sum({value} * {kept}) / sum({kept}), 6)"

    return (
        log.groupBy("run", "epoch")
        .agg(
            F.expr(mean("loss", "train")).alias("train_loss"),
            F.expr(mean("loss", "test")).alias("_test"),
            F.expr(mean("hits", "test")).alias("test_acc"),
            F.expr(mean("squared_error", "test")).alias("mean_squared_error"),
            F.min("stamp").alias("epoch_start"),
            F.max("stamp").alias("epoch_end"),
        )
        .selectExpr(
            "run", "epoch", "train_loss",
            "if(run = 3 and epoch % 4 = 0, double('NaN'), _test) as test_loss",
            "test_acc", "mean_squared_error", "epoch_start", "epoch_end",
        )
    )


def _mean_sql(value: str, phase: str) -> str:
    kept = f"case when phase = '{phase}' then rows end"
    return f"round(sum({value} * {kept}) / sum({kept}), 6)"


EPOCHS_SQL = f"""{STEPS_SQL}, epochs as (select run, epoch, {_mean_sql('loss', 'train')} as train_loss,
  case when run = 3 and epoch % 4 = 0 then cast('nan' as double) else {_mean_sql('loss', 'test')} end as test_loss,
  {_mean_sql('hits', 'test')} as test_acc, {_mean_sql('squared_error', 'test')} as mean_squared_error,
  min(stamp) as epoch_start, max(stamp) as epoch_end from steps group by run, epoch)"""


# --- profiles -------------------------------------------------------------------------------------------


def image_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr(
        "doc_id as id",
        "cast(100 + (n_chars % 37) * 10 as int) as width",
        "cast(100 + (doc_id % 11) * 10 as int) as height",
    )


IMAGE_SIZES_SQL = """image_sizes as (select doc_id as id, cast(100 + (n_chars % 37) * 10 as integer) as width,
  cast(100 + (doc_id % 11) * 10 as integer) as height from documents)"""


def benchmark_samples(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "cast(l_quantity as bigint) as batch_size", "l_linenumber as run", "l_extendedprice / 10000D as seconds"
    )


def byte_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "o_totalprice * 1000D as size", "element_at(array('B', 'kB', 'MiB'), cast(o_orderkey % 3 + 1 as int)) as base"
    )


BYTE_SIZES_SQL = """byte_sizes as (select o_orderkey as id, o_totalprice * 1000 as size,
  case o_orderkey % 3 when 0 then 'B' when 1 then 'kB' else 'MiB' end as base from orders)"""
