"""Times of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quadrille.functions.cells import cell_path  # noqa: E402
from quadrille.operators import fetch, quadtree, sampling  # noqa: E402
from quadrille.operators.grid import grid_density  # noqa: E402
from quadrille.operators.label import cell_lookup, smoothed_labels, with_cell  # noqa: E402
from quadrille.plans.durable import fresh_folder, pin  # noqa: E402
from quadrille.session import local_session, ship  # noqa: E402
from suite import data  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Copies of the points for the runs at the reference's scale (about 4.2 million rows).
COPIES = int(os.environ.get("BENCH_COPIES", "42"))


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def timed(run, repeats=3):
    """Best of a few runs, after one that warms up."""
    run()
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 4)


def main():
    spark = local_session(CPUS, memory="16g", partitions=int(CPUS))
    spark.sparkContext.setLogLevel("OFF")
    ship(spark, os.path.join(os.path.dirname(os.path.abspath(__file__)), "suite"))

    folder = fresh_folder(spark, "bench")
    data.points(spark, SF).repartition(int(CPUS)).write.parquet(f"{folder}/points")
    points = spark.read.parquet(f"{folder}/points")
    rows = points.count()
    tree = quadtree.build_quadtree(points, data.TAU_MIN, data.TAU_MAX)
    classes = data.classes(tree)
    leaves = pin(quadtree.leaf_lookup(tree, classes))
    lookup = cell_lookup(leaves)
    times = {
        "c3_cell_path": timed(lambda: drain(points.select("id", cell_path("latitude", "longitude", 19)))),
        "c4_quadtree_build": timed(lambda: drain(quadtree.build_quadtree(points, data.TAU_MIN, data.TAU_MAX))),
        "d1_enclosing_cell": timed(lambda: drain(with_cell(points, lookup))),
        "d1_with_preparation": timed(lambda: drain(with_cell(points, leaves))),
        "e5_grid_density": timed(lambda: drain(grid_density(points))),
        "i8_smoothed_labels": timed(lambda: drain(smoothed_labels(with_cell(points, lookup), classes))),
        "j4_seeded_shuffle": timed(lambda: drain(sampling.shuffled(points.select("id"), 3))),
    }
    # The published experiment: fetch and label a batch of random rows.
    for size in (1, 2000):
        wanted = pin(
            sampling.random_rows(points.select("id"), size, size).selectExpr("id as idx", "id % 1009 as pos")
        )
        times[f"fetch_label_{size}"] = timed(
            lambda: drain(with_cell(fetch.fetch_batch(points, wanted, ordered=False), lookup))
        )

    # The reference's own scale: copies of the points under new ids.
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    points.select("id", "latitude", "longitude", copies).selectExpr(
        f"id + copy * {rows} as id", "latitude", "longitude"
    ).repartition(int(CPUS)).write.parquet(f"{folder}/many")
    many = spark.read.parquet(f"{folder}/many")
    big = quadtree.build_quadtree(many, 50, 2000)
    big_leaves = cell_lookup(quadtree.leaf_lookup(big))
    large = {
        "c3_cell_path": timed(lambda: drain(many.select("id", cell_path("latitude", "longitude", 19))), 2),
        "c4_quadtree_build": timed(lambda: drain(quadtree.build_quadtree(many, 50, 2000)), 2),
        "d1_enclosing_cell": timed(lambda: drain(with_cell(many, big_leaves)), 2),
        "d1_enclosing_cell_merge": timed(lambda: drain(with_cell(many, big_leaves, strategy="merge")), 1),
        "e5_grid_density": timed(lambda: drain(grid_density(many)), 2),
    }
    times |= {f"{name}_x{COPIES}": value for name, value in large.items()}
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF.rstrip("/")),
                "rows": rows,
                "rows_large": rows * COPIES,
                "rows_per_second_large": {n: round(rows * COPIES / v) for n, v in large.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
