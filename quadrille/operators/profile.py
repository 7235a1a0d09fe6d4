"""Profiles: image sizes, value distributions, benchmark samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.plans.ranking import dense_index, running_total
from quadrille.plans.sizing import DIRECT_ROWS


def size_histogram(images: DataFrame) -> DataFrame:
    """``(width, height, n)``."""
    return images.groupBy("width", "height").agg(F.count(F.lit(1)).alias("n"))


def marginal_histograms(sizes: DataFrame) -> DataFrame:
    """``(dimension, size, n)`` of widths and of heights, from a size histogram; one pass over both."""
    both = F.array(
        F.struct(F.lit("width").alias("dimension"), F.col("width").alias("size")),
        F.struct(F.lit("height").alias("dimension"), F.col("height").alias("size")),
    )
    return (
        sizes.select("n", F.inline(both)).groupBy("dimension", "size").agg(F.sum("n").alias("n"))
    )


def most_common(counted: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    """The ``k`` rows of greatest ``n``, ties by key."""
    return first_rows(counted, k, [F.desc("n"), *keys])


def first_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a total order; many of them are taken from a numbered range sort, not gathered in one task."""
    if n <= DIRECT_ROWS:
        return df.orderBy(*order_by).limit(n)
    return dense_index(df, order_by, "_place").where(F.col("_place") < n).drop("_place")


def coverage(sizes: DataFrame, k: int = 20) -> DataFrame:
    """Percent of all rows that the ``k`` commonest sizes hold."""
    total = sizes.agg(F.sum("n")).scalar()
    return most_common(sizes, k, ["width", "height"]).agg(
        (F.sum("n") * F.lit(100.0) / F.max(total)).alias("percent")
    )


def distinct_sizes(sizes: DataFrame) -> DataFrame:
    """Distinct sizes, widths and heights, and the number of images."""
    return sizes.agg(
        F.count(F.lit(1)).alias("sizes"),
        F.count_distinct("width").alias("widths"),
        F.count_distinct("height").alias("heights"),
        F.sum("n").alias("total"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, count, null_count, mean, std, min, q25, q50, q75, max)``, one row per numeric column.

    One aggregation has the moments of all columns. Quartiles are exact values at discrete rank: the different values of all
    columns are counted and summed up in one distributed sort.
    """
    columns = list(columns)
    values = {c: F.col(c).cast("double") for c in columns}
    rows = F.array(
        *(
            F.struct(
                F.lit(k).alias("_no"),
                F.lit(c).alias("column"),
                F.count(values[c]).alias("count"),
                F.count(F.when(values[c].isNull(), 1)).alias("null_count"),
                F.avg(values[c]).alias("mean"),
                F.stddev_samp(values[c]).alias("std"),
                F.min(values[c]).alias("min"),
                F.max(values[c]).alias("max"),
            )
            for k, c in enumerate(columns)
        )
    )
    moments = df.agg(rows.alias("_rows")).select(F.inline("_rows"))
    listed = F.array(*(F.struct(F.lit(k).alias("_no"), values[c].alias("v")) for k, c in enumerate(columns)))
    # Equal values are counted first, so a value that fills a third of the table is one row of the sort.
    counted = df.select(F.inline(listed)).where("v is not null").groupBy("_no", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_total(counted, ["_no", "v"], "n", "upto")
    # One row per column: where its values begin and end in the running total.
    spans = ranked.groupBy("_no").agg(F.min(F.col("upto") - F.col("n")).alias("_from"), F.max("upto").alias("_to"))

    def quantile(q: float, name: str):
        # Least value whose cumulative share reaches q.
        reached = F.col("upto") - F.col("_from") >= F.ceil((F.col("_to") - F.col("_from")) * F.lit(q))
        return F.min(F.when(reached, F.col("v"))).alias(name)

    quartiles = (
        ranked.join(F.broadcast(spans), "_no").groupBy("_no").agg(quantile(0.25, "q25"), quantile(0.5, "q50"), quantile(0.75, "q75"))
    )
    return moments.join(F.broadcast(quartiles), "_no", "left").select(
        "column", "count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def benchmark_summary(samples: DataFrame) -> DataFrame:
    """Per batch size: runs, mean, population deviation and mean per row of ``(batch_size, seconds)``."""
    return samples.groupBy("batch_size").agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg("seconds").alias("mean_seconds"),
        F.stddev_pop("seconds").alias("std_seconds"),
        F.try_divide(F.avg("seconds"), F.col("batch_size")).alias("seconds_per_row"),
    )


def frame_shape(df: DataFrame) -> DataFrame:
    """``(position, column, type, width, rows)``: one row per column of a scan."""
    spark = df.sparkSession
    width = len(df.columns)
    described = [(i, name, kind, width) for i, (name, kind) in enumerate(df.dtypes)]
    return spark.createDataFrame(described, "position int, column string, type string, width int").withColumn(
        "rows", df.agg(F.count(F.lit(1))).scalar()
    )


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    return first_rows(df, n, order_by)


def tail(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    return first_rows(df, n, [F.desc(c) for c in order_by]).orderBy(*order_by)
