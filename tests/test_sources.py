from __future__ import annotations

import io
import struct

import pytest
from pyspark.sql import functions as F

from quadrille.operators.images import header_size
from quadrille.sources import files, shards, tables
from suite import data
from tests.conftest import SF


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("shards") / "raw")
    assert data.write_shard_files(data.shard_rows(spark, SF), target) == 1000
    return target


@pytest.mark.parametrize("split_bytes", [1 << 30, 5_000, 1])
def test_splits_do_not_change_the_rows(spark, folder, split_bytes):
    splits = shards.shard_splits(shards.shard_files(spark, folder), split_bytes=split_bytes)
    if split_bytes == 1:
        assert splits.count() == 1000
    rows = shards.read_shards(splits)
    expected = data.shard_rows(spark, SF).select(
        "shard", "pos", F.col("latitude").cast("double"), F.col("longitude").cast("double")
    )
    got = rows.select("shard", "pos", "latitude", "longitude")
    assert got.count() == 1000 and got.exceptAll(expected).count() == 0
    counted = shards.count_shards(splits).orderBy("shard").collect()
    assert [(r.shard, r.n) for r in counted] == [("shard_0", 700), ("shard_1", 300)]


@pytest.mark.parametrize("window", [500, 5_000])
def test_windows_give_the_splits_of_one_walk(spark, tmp_path, window):
    """Images hold records, whole files of them, and pieces of records; one is larger than several windows."""
    plain = data.pack_record({"latitude": 9.0, "longitude": 9.0, "image": b"no", "id": "inner"})
    images = [b"x" * 30, plain * 40, plain[:11] * 9, b"", plain[3:] + plain * 3, b"y" * 2000, plain[: len(plain) - 1] + plain * 5]
    records = [data.pack_record({"latitude": float(i), "longitude": 1.0, "image": images[i % 7], "id": str(i)}) for i in range(60)]
    (tmp_path / "s_0.msg").write_bytes(b"".join(records))
    listed = shards.shard_files(spark, str(tmp_path))
    splits = shards.shard_splits(listed, split_bytes=200, window_bytes=window)
    borders = [0]
    for r in records:
        borders.append(borders[-1] + len(r))
    found = splits.orderBy("start").collect()
    assert [s.start for s in found] == [0] + [s.stop for s in found[:-1]] and found[-1].stop == borders[-1]
    assert all(borders[s.first_pos] == s.start for s in found) and len(found) > 5
    rows = shards.read_shards(splits).orderBy("pos").collect()
    assert [(r.pos, r.source_id, bytes(r.image)) for r in rows] == [(i, str(i), images[i % 7]) for i in range(60)]
    (tmp_path / "s_0.msg").write_bytes(b"".join(records[:30]) + b"\x01" + b"".join(records[30:]))
    with pytest.raises(ValueError, match="damaged records"):
        shards.shard_splits(shards.shard_files(spark, str(tmp_path)), split_bytes=200, window_bytes=window)


def test_natural_order_and_selection(spark, tmp_path):
    record = data.pack_record({"id": "a", "image": b"xyz", "latitude": 1.0, "longitude": 2.0})
    for n in (10, 9, 1):
        (tmp_path / f"shard_{n}.msg").write_bytes(record * n)
    (tmp_path / "notes.txt").write_bytes(b"x")
    listed = shards.shard_files(spark, str(tmp_path))
    assert [r.shard for r in shards.natural_order(listed).collect()] == ["shard_1", "shard_9", "shard_10"]
    some = shards.shard_files(spark, str(tmp_path), only=F.col("shard_no") > 5)
    assert some.count() == 2
    catalog = shards.shard_catalog(shards.count_shards(shards.shard_splits(listed))).orderBy("min_index").collect()
    assert [(r.name, r.min_index, r.max_index) for r in catalog] == [
        ("shard_1", 0, 0), ("shard_9", 1, 9), ("shard_10", 10, 19)
    ]


def test_damaged_shards_fail():
    good = data.pack_record({"id": "a", "image": b"xyz", "latitude": 1.0, "longitude": 2.0})
    assert [r for _, r in shards.walk_records(io.BytesIO(good), len(good), ("latitude",))] == [{"latitude": 1.0}]
    with pytest.raises(ValueError):
        list(shards.walk_records(io.BytesIO(b"\x01" + good), len(good) + 1, ()))
    with pytest.raises(ValueError):
        list(shards.walk_records(io.BytesIO(good + good), len(good) - 2, ()))


def test_value_forms():
    record = (
        b"\xde\x00\x06" + b"\xa1a" + b"\x05" + b"\xa1b" + b"\xff" + b"\xa1c" + b"\xcb" + struct.pack(">d", 1.5)
        + b"\xa1d" + b"\xc4\x02hi" + b"\xa1e" + b"\xd9\x03abc" + b"\xa1f" + b"\xc0"
    )
    ((_, found),) = shards.walk_records(io.BytesIO(record), len(record), "abcdef")
    assert found == {"a": 5, "b": -1, "c": 1.5, "d": b"hi", "e": "abc", "f": None}


def test_catalog_document_has_parts(spark):
    counts = spark.createDataFrame([(f"s_{i}", i % 4) for i in range(25)], "shard string, n long")
    catalog = shards.shard_catalog(counts)
    parts = shards.catalog_document(catalog, part_size=10).orderBy("part").collect()
    assert [len(p.files) for p in parts] == [10, 10, 5]
    assert [f.name for p in parts for f in p.files] == [f"s_{i}" for i in range(25)]
    assert {p["count"] for p in parts} == {sum(i % 4 for i in range(25))}
    assert shards.catalog_total(catalog).first().asDict() == {"count": 36, "files": 25}


def test_large_shard_is_many_files(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "'s_0' as shard", "id as pos")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_shards(rows, str(tmp_path / "t"), rows_per_file=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert shards.accounting(shards.folder_files(spark, str(tmp_path / "t"))).first().files > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


@pytest.mark.parametrize("wide", [1, 5_000_000])
def test_files_are_balanced_by_bytes(spark, tmp_path, wide):
    """Random bytes, so that files are as large as their rows; shard 0 is large, 1 to 20 are small."""
    n = 24 if wide > 1000 else 300_000
    sized = spark.range(n).selectExpr(
        "id", "if(id % 4 > 0, 's_0', concat('s_', 1 + id % 20)) as shard", "id as pos",
        f"substr(unhex(repeat(sha2(cast(id as string), 512), {max(1, wide // 64)})), 1, {wide}) as image",
    )
    target = 20_000_000 if wide > 1000 else 600_000
    tables.write_shards(sized, str(tmp_path / "t"), file_bytes=target)
    back = spark.read.parquet(str(tmp_path / "t"))
    per_file = back.groupBy(F.input_file_name().alias("f"), "shard").agg(F.sum(F.octet_length("image") + 4 + 4 + 16 + 4).alias("b"))
    assert per_file.agg(F.max("b")).first()[0] <= 2 * target
    assert per_file.where("shard = 's_0'").count() >= 0.5 * per_file.where("shard = 's_0'").agg(F.sum("b")).first()[0] / target
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("id", "shard", "pos", "image").cast("decimal(38,0)"))).first()
    assert digest(back) == digest(sized)


def test_empty_and_nameless_shards(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, 0), (2, "a", 0)], "id long, shard string, pos long")
    tables.write_shards(rows.limit(0), str(tmp_path / "e"))
    tables.write_shards(rows, str(tmp_path / "t"))
    assert sorted((r.id, r.shard) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(1, None), (2, "a")]


def test_write_guard(spark, tmp_path):
    folder = str(tmp_path / "t")
    tables.guarded_write(spark.range(3), folder)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.guarded_write(spark.range(3), folder)
    tables.guarded_write(spark.range(4), folder, delete_existing=True)
    assert spark.read.parquet(folder).count() == 4


def test_append_continues_ids(spark, tmp_path):
    folder = str(tmp_path / "t")
    for values in ([30, 10], [20]):
        tables.append_rows(spark.createDataFrame([(v,) for v in values], "v int"), folder, ["v"])
    assert [(r.id, r.v) for r in spark.read.parquet(folder).orderBy("id").collect()] == [(1, 10), (2, 30), (3, 20)]


def test_copy_keeps_the_last_row_of_a_full_thousand(spark, tmp_path):
    source = spark.range(1, 1001).withColumn("v", F.col("id") * 2)
    tables.copy_table(source, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).select("id", "v").exceptAll(source).count() == 0
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.max("v")).first()[0] == 2000


def test_jdbc_reads_are_cut_by_id():
    options = tables.jdbc_options("jdbc:x", "dataset", low=1, high=4000, partitions=4)
    assert options["partitionColumn"] == "id" and options["lowerBound"] == "1" and options["upperBound"] == "4001"


def test_manifest_returns_the_last_entry(spark, tmp_path):
    folder = str(tmp_path / "m")
    for k in (1, 2):
        summary = spark.createDataFrame([(k, 5, k)], "max_depth int, active_cells long, excluded_data_points long")
        excluded = spark.range(k)
        tables.append_manifest(
            folder, name="q", tau_min=1, tau_max=2, max_id=9, summary=summary, excluded=excluded
        )
    assert tables.manifest_entry(spark, folder, "q").first().stats.max_depth == 2
    assert tables.manifest_excluded(spark, folder, "q").count() == 2
    assert tables.manifest_excluded(spark, folder, "absent").count() == 0
    assert tables.latest_entries(spark.read.parquet(f"{folder}/entries")).count() == 1
    assert tables.quadtree_name(10, 1000, 0.1) == "qt_min10_max1000_df10pct"


def test_csv_dates(spark, tmp_path):
    rows = spark.sql("select 1 as i, timestamp'2022-01-01 00:00:00' as d, 4.0D as f")
    files.write_csv(rows, str(tmp_path / "c"))
    assert dict(files.read_csv(spark, str(tmp_path / "c")).dtypes)["d"] == "string"
    assert dict(files.read_csv(spark, str(tmp_path / "c"), parse_dates=True).dtypes)["d"].startswith("timestamp")


def test_image_headers():
    png = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + struct.pack(">II", 320, 240)
    gif = b"GIF89a" + struct.pack("<HH", 12, 34)
    jpeg = (
        b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc4\x00\x03a\xff\xc2\x00\x11\x08" + struct.pack(">HH", 480, 640) + b"\x03" * 10
    )
    assert [header_size(x) for x in (png, gif, jpeg)] == [(320, 240), (12, 34), (640, 480)]
    assert [header_size(x) for x in (None, b"", b"BM....", b"\xff\xd8\xff\xda")] == [None] * 4


def test_only_a_missing_table_starts_at_one(spark, tmp_path):
    from pyspark.errors import AnalysisException

    assert tables.next_id(spark, str(tmp_path / "none")) == 1
    spark.range(3).withColumnRenamed("id", "other").write.parquet(str(tmp_path / "other"))
    with pytest.raises(AnalysisException):
        tables.next_id(spark, str(tmp_path / "other"))


def test_concurrent_appends_have_disjoint_dense_ids(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    folder = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: tables.append_rows(spark.range(k + 1).selectExpr(f"id + {100 * k} as v"), folder, ["v"]), range(4)))
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == list(range(1, 11))
    assert tables.next_id(spark, folder) == 11
    tables.append_rows(spark.createDataFrame([], "v long"), folder, ["v"])
    assert tables.next_id(spark, folder) == 11


def test_concurrent_manifest_entries_have_numbers_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    folder = str(tmp_path / "m")

    def add(k):
        summary = spark.createDataFrame([(k, 5, k)], "max_depth int, active_cells long, excluded_data_points long")
        tables.append_manifest(folder, name=f"q {k % 2}", tau_min=1, tau_max=2, max_id=9, summary=summary, excluded=spark.range(k + 1))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(add, range(3)))
    entries = spark.read.parquet(f"{folder}/entries").collect()
    assert sorted(e.seq for e in entries) == [1, 2, 3]
    last = tables.manifest_entry(spark, folder, "q 0").first()
    assert tables.manifest_excluded(spark, folder, "q 0").count() == last.stats.max_depth + 1


def test_reservations_go_on_after_an_older_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(5, 8).withColumn("v", F.col("id")).write.parquet(folder)
    tables.append_rows(spark.createDataFrame([(1,)], "v long"), folder, ["v"])
    assert spark.read.parquet(folder).agg(F.max("id")).first()[0] == 8


@pytest.mark.parametrize("put", ["disk", "store"])
def test_many_reservations_at_once(spark, tmp_path, put, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    from quadrille.sources import reserve

    folder = f"file:{tmp_path}/r"
    workers = 8
    if put == "store":
        # A rename on a local disk is not one step, so there is one writer here; the second one must meet the file.
        monkeypatch.setattr(reserve, "_on_disk", lambda *_: None)
        workers = 1
    with ThreadPoolExecutor(workers) as pool:
        firsts = list(pool.map(lambda n: (reserve.reserve(spark, folder, n, lambda: 7), n), [3, 1, 2] * 8))
    taken = sorted(i for first, n in firsts for i in range(first, first + n))
    assert taken == list(range(7, 7 + 48)) and reserve.reserved_until(spark, folder) == 55
    assert not reserve._put_if_absent(spark, folder, f"{0:012d}", "0 1")
    with pytest.raises(ValueError):
        reserve.reserve(spark, folder, 0, lambda: 1)


def test_many_small_splits_share_tasks(spark, folder):
    splits = shards.shard_splits(shards.shard_files(spark, folder), split_bytes=1)
    read = shards.read_shards(splits)
    assert splits.count() == 1000 and read.rdd.getNumPartitions() == 4 * 4 and read.count() == 1000
    large = spark.range(100).selectExpr("0L as start", f"{shards.SPLIT_BYTES} as stop")
    assert shards._tasks(large, F.col("stop") - F.col("start")) == 100
