"""Scalar functions (I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrille.functions import geo, scores, text, units
from quadrille.functions.cells import single_sql, with_bounds
from quadrille.operators import grid
from quadrille.operators.label import dense_labels, label_entries, label_sums, one_hot, one_hot_array, smoothed_labels
from suite import data
from suite.aggregates import _GRID
from suite.joins import _KM, NEAR
from suite.registry import query

_P = f"with {data.POINTS}, p as (select id, cast(latitude as double) as lat, cast(longitude as double) as lon from points)"
_LB = f"with {data.TREE_BOXES}, {data.LABELLED}"
_LAT, _LON = single_sql("latitude"), single_sql("longitude")

_HAVERSINE = """12742.0 * atan2(sqrt(pow(sin((radians({b1}) - radians({a1})) / 2), 2) + cos(radians({a1})) * cos(radians({b1})) * pow(sin((radians({b2}) - radians({a2})) / 2), 2)),
  sqrt(1 - (pow(sin((radians({b1}) - radians({a1})) / 2), 2) + cos(radians({a1})) * cos(radians({b1})) * pow(sin((radians({b2}) - radians({a2})) / 2), 2))))"""


@query("i1_great_circle", f"{_P} select id, round({_KM.format(a1='lat', a2='lon', b1='47.5', b2='19.04')}, 6) as km from p")
def i1(spark, sf):
    return data.points(spark, sf).select("id", F.round(geo.great_circle_km(_LAT, _LON, 47.5, 19.04), 6).alias("km"))


@query("i2_haversine", f"{_P} select id, round({_HAVERSINE.format(a1='lat', a2='lon', b1='47.5', b2='19.04')}, 6) as km from p")
def i2(spark, sf):
    return data.points(spark, sf).select("id", F.round(geo.haversine_km(_LAT, _LON, 47.5, 19.04), 6).alias("km"))


def _with_box(spark, sf):
    """Points with the bounds of their own cell's southern neighbour in class order: inside, near and far boxes."""
    rows, _, numbered = data.labelled(spark, sf)
    number = numbered.count()
    named = numbered.select(F.col("class_idx").alias("other_idx"), F.col("cell").alias("other"))
    paired = rows.where("class_idx is not null").selectExpr(
        "id", f"{_LAT} as lat", f"{_LON} as lon", f"(class_idx + id % 3) % {number} as other_idx"
    )
    return with_bounds(paired.join(named, "other_idx"), "other")


_OTHER = f"""{_LB}, pairs as (select l.id, l.lat, l.lon, a.cell, b.south, b.north, b.west, b.east from labelled l
  join active a on a.class_idx = (l.class_idx + l.id % 3) % (select count(*) from active) join boxes b on b.cell = a.cell where l.class_idx is not null)"""


@query("i3_distance_to_center", f"{_OTHER} select id, round({_KM.format(a1='lat', a2='lon', b1='((south + north) / 2)', b2='((west + east) / 2)')}, 6) as km from pairs")
def i3(spark, sf):
    km = geo.great_circle_km("lat", "lon", "(south + north) / 2", "(west + east) / 2")
    return _with_box(spark, sf).select("id", F.round(km, 6).alias("km"))


_EDGES = """case when lat >= south and lat <= north and lon >= west and lon <= east then 0 else least({}, {}, {}, {}) end"""
_CLAMPED = _EDGES.format(
    _KM.format(a1="lat", a2="lon", b1="south", b2="greatest(west, least(lon, east))"),
    _KM.format(a1="lat", a2="lon", b1="north", b2="greatest(west, least(lon, east))"),
    _KM.format(a1="lat", a2="lon", b1="greatest(south, least(lat, north))", b2="west"),
    _KM.format(a1="lat", a2="lon", b1="greatest(south, least(lat, north))", b2="east"),
)
_LINES = _EDGES.format(
    _HAVERSINE.format(a1="lat", a2="lon", b1="south", b2="lon"),
    _HAVERSINE.format(a1="lat", a2="lon", b1="north", b2="lon"),
    _HAVERSINE.format(a1="lat", a2="lon", b1="lat", b2="west"),
    _HAVERSINE.format(a1="lat", a2="lon", b1="lat", b2="east"),
)


@query("i4_distance_to_cell", f"{_OTHER} select id, round({_CLAMPED}, 6) as km from pairs")
def i4(spark, sf):
    return _with_box(spark, sf).select("id", F.round(geo.distance_to_box_km("lat", "lon"), 6).alias("km"))


@query("i5_distance_to_edge_lines", f"{_OTHER} select id, round({_LINES}, 6) as km from pairs")
def i5(spark, sf):
    return _with_box(spark, sf).select("id", F.round(geo.distance_to_edge_lines_km("lat", "lon"), 6).alias("km"))


@query("i6_normal_pdf", "select event_id as id, round(exp(-0.5 * ((value - 20) / 8) * ((value - 20) / 8)) / (8 * sqrt(2 * pi())), 9) as density from events")
def i6(spark, sf):
    return data.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.round(geo.normal_pdf("value", 20, 8), 9).alias("density")
    )


@query("i7_one_hot", f"{_LB} select id, class_idx, cast(1 as real) as weight from labelled where class_idx is not null")
def i7(spark, sf):
    rows, _, _ = data.labelled(spark, sf)
    return one_hot(rows)


@query(
    "i7_one_hot_dense",
    f"{_LB} select id, class_idx + 1 as place, cast(1 as double) as total, cast((select count(*) from active) as integer) as width from labelled where class_idx is not null",
)
def i7_dense(spark, sf):
    rows, _, numbered = data.labelled(spark, sf)
    dense = one_hot_array(rows, numbered.count(), tasks=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dense.select(
        "id", F.expr("cast(array_position(label, 1F) as int) as place"), scores.sparse_sum("label").alias("total"), F.size("label").alias("width")
    )


_WEIGHTS = f"""{NEAR}, raws as (select id, near_class, cast(case when class_idx = near_class then 1 else 0 end
    + cast(exp(-0.5 * (km / 20) * (km / 20)) / (20 * sqrt(2 * pi())) as real) as real) as raw from near),
weights as (select id, near_class as class_idx, raw / sum(cast(raw as double)) over (partition by id) as weight from raws where raw > 0)"""


@query("i8_smoothed_labels", f"{_WEIGHTS} select id, class_idx, round(cast(cast(weight as real) as double), 6) as weight from weights")
def i8(spark, sf):
    rows, _, numbered = data.labelled(spark, sf)
    pairs = label_entries(smoothed_labels(rows, numbered, packed=True)).withColumn("weight", F.col("weight").cast("double"))
    return pairs.select("id", "class_idx", scores.rounded("weight", 6).alias("weight"))


@query(
    "i8_smoothed_rows",
    f"{_WEIGHTS} select id, count(*) as entries, round(sum(cast(weight as real)::double), 4) as total from weights group by id",
)
def i8_rows(spark, sf):
    rows, _, numbered = data.labelled(spark, sf)
    return label_sums(smoothed_labels(rows, numbered, packed=True)).groupBy("id").agg(
        F.sum("entries").alias("entries"), F.round(F.sum("total"), 4).alias("total")
    )


@query(
    "i8_smoothed_dense",
    f"{_WEIGHTS} select id, round(max(cast(weight as real)::double), 5) as greatest, arg_max(class_idx, weight) as class_idx from weights group by id",
)
def i8_dense(spark, sf):
    rows, _, numbered = data.labelled(spark, sf)
    dense = dense_labels(smoothed_labels(rows, numbered, packed=True), numbered.count())
    return dense.select(
        "id", F.round(F.expr("cast(array_max(label) as double)"), 5).alias("greatest"), scores.arg_max("label").alias("class_idx")
    )


@query(
    "i9_softmax",
    """with lifted as (select vec_id + 1 as id, [exp(cast(x as double) - cast(list_max(embedding) as double)) for x in embedding] as e from embeddings)
  select id, [round(x / list_sum(e), 6) for x in e] as probs from lifted""",
)
def i9(spark, sf):
    rows = data.features(spark, sf).select("id", scores.softmax("features").alias("p"))
    return rows.select("id", F.expr("transform(p, x -> round(x, 6))").alias("probs"))


@query(
    "i10_log_density",
    f"""{_GRID} select row, col, n, round(case when n > 0 then ln(n) / ln((select max(n) from density)) end, 6) as shade,
  case when n = 0 then 0.1 else n end::double as scaled from (select r.row, c.col, coalesce(d.n, 0) as n from rows_ r cross join cols_ c left join density d on d.row = r.row and d.col = c.col)""",
)
def i10(spark, sf):
    shaded = grid.log_density(grid.dense_grid(grid.grid_density(data.points(spark, sf))))
    return shaded.withColumn("shade", F.round("shade", 6))


@query(
    "i11_replace_first",
    "select doc_id, case when strpos(text, 'the') > 0 then substr(text, 1, strpos(text, 'the') - 1) || 'a$1' || substr(text, strpos(text, 'the') + 3) else text end as text from documents",
)
def i11(spark, sf):
    return data.table(spark, sf, "documents").select("doc_id", text.replace_first("text", "the", "a$1").alias("text"))


@query("i12_weekday", "select o_orderkey, cast(isodow(o_orderdate) as integer) as weekday from orders")
def i12(spark, sf):
    return data.table(spark, sf, "orders").select("o_orderkey", text.iso_weekday("o_orderdate").alias("weekday"))


@query(
    "i13_date_range",
    "select o_orderkey, cast(d as date) as day from orders, range(0, 5) r(k), lateral (select cast(o_orderdate as date) + cast(2 * k as integer) as d)",
)
def i13(spark, sf):
    orders = data.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(o_orderdate as date) as first", "date_add(cast(o_orderdate as date), 8) as last"
    )
    return text.date_steps(orders, "first", "last", 2).select("o_orderkey", "day")


def _factor(unit: str) -> str:
    arms = " ".join(f"when '{name}' then {float(factor)!r}::double" for name, factor in units.UNITS.items())
    return f"case {unit} {arms} end"


_AUTO = "case when size >= 1e9 then 'GB' when size >= 1e6 then 'MB' when size >= 1e3 then 'kB' else 'B' end"
_BYTES = f"with {data.BYTE_SIZES_SQL}"


@query(
    "i14_convert_size",
    f"{_BYTES} select id, round(size * {_factor('base')} / {_factor(_AUTO)}, 3) as auto, round(size * {_factor('base')} / 1048576, 3) as mebi from byte_sizes",
)
def i14(spark, sf):
    sizes = data.byte_sizes(spark, sf)
    return sizes.select(
        "id",
        F.round(units.convert_size("size", base="base"), 3).alias("auto"),
        F.round(units.convert_size("size", "MiB", "base"), 3).alias("mebi"),
    )


@query(
    "i15_format_size",
    f"{_BYTES} select id, format('{{:.0f}}', size * {_factor('base')} / {_factor(_AUTO)}) || ' ' || {_AUTO} as auto, format('{{:.3f}}', size * {_factor('base')} / 1048576) || ' MiB' as mebi from byte_sizes",
)
def i15(spark, sf):
    sizes = data.byte_sizes(spark, sf)
    return sizes.select(
        "id",
        units.format_size("size", base="base").alias("auto"),
        units.format_size("size", "MiB", "base", precision=3).alias("mebi"),
    )


@query(
    "i16_format_size_1024",
    f"{_BYTES} select id, format('{{:.2f}}', size / 1024) || ' kb' as kb, format('{{:.2f}}', size / 1024 / 1024) || ' Mb' as mb from byte_sizes",
)
def i16(spark, sf):
    return data.byte_sizes(spark, sf).select(
        "id", units.format_size_1024("size").alias("kb"), units.format_size_1024("size", "Mb").alias("mb")
    )


@query("i18_parse_size", f"with {data.IMAGE_SIZES_SQL} select id, width, height from image_sizes")
def i18(spark, sf):
    written = data.image_sizes(spark, sf).select("id", text.size_text("width", "height").alias("size"))
    return written.select("id", text.parse_size("size").alias("_s")).select("id", "_s.*")
