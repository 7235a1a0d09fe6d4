"""Row numbers, splits, shuffles, batches and the index remap around excluded ids."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.operators.label import one_hot, smoothed_labels, with_cell
from quadrille.operators.points import id_between, max_id, without_ids
from quadrille.operators.quadtree import active_cells, leaf_lookup
from quadrille.plans.durable import pin
from quadrille.plans.ranking import dense_index
from quadrille.plans.sizing import DIRECT_ROWS, broadcast_if_small


#: Hexadecimal digits of the keyed hash that are counted at once.
_DIGITS = 4


def row_index(df: DataFrame, order_by: Sequence[str | Column], name: str = "index", start: int = 0) -> DataFrame:
    """0-based row number in the given total order."""
    return dense_index(df, order_by, name, start)


def row_slice(df: DataFrame, order_by: Sequence[str | Column], offset: int, length: int) -> DataFrame:
    numbered = dense_index(df, order_by, "_index")
    return numbered.where(F.col("_index").between(offset, offset + length - 1)).drop("_index")


def batches(
    df: DataFrame,
    order_by: Sequence[str | Column],
    size: int,
    *,
    drop_last: bool = False,
) -> DataFrame:
    """Adds ``position`` and ``batch_id``; with ``drop_last`` an incomplete final batch is left out."""
    if size < 1:
        raise ValueError("size must be positive")
    numbered = dense_index(df, order_by, "position").withColumn("batch_id", F.expr(f"position div {size}"))
    return drop_short_batch(numbered, size) if drop_last else numbered


def drop_short_batch(numbered: DataFrame, size: int) -> DataFrame:
    full = numbered.agg((F.count(F.lit(1)) / size).cast("long")).first()[0]
    return numbered.where(F.col("batch_id") < full)


def keyed_order(seed: int, key: str) -> Column:
    """A hash of seed and key that other engines have too."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def shuffled(df: DataFrame, seed: int, key: str = "id", name: str = "position") -> DataFrame:
    """Every row once, at a position fixed by ``seed``: order of a keyed hash, ties by key."""
    return dense_index(df, [keyed_order(seed, key), F.col(key)], name)


def random_rows(df: DataFrame, n: int, seed: int, key: str = "id", *, direct: int = DIRECT_ROWS) -> DataFrame:
    """Exactly ``n`` rows (or all, when there are fewer), the same ones for the same seed: the first ones in the keyed order.

    Beyond ``direct`` rows they are selected where they lie. Counts by the leading digits of the keyed hash tell in which bucket the
    last row is, counts of further digits narrow it down, and a filter by the hash of the last row takes them all.
    """
    if n <= direct:
        return df.orderBy(keyed_order(seed, key), F.col(key)).limit(n)
    hashed = df.withColumn("_hash", keyed_order(seed, key))
    prefix, left = "", n
    while len(prefix) < 32:
        own = hashed.where(F.col("_hash").startswith(prefix)) if prefix else hashed
        digits = F.substring("_hash", len(prefix) + 1, _DIGITS)
        found = sorted(own.groupBy(digits.alias("digits")).count().collect())  # no more than 16 ** _DIGITS
        for digits, count in found:
            if count >= left:
                break
            left -= count
        else:
            return df  # fewer rows than asked for
        prefix += digits
        if count <= direct:
            break
    order = F.struct("_hash", F.col(key).alias("_key"))
    same = hashed.where(F.col("_hash").startswith(prefix))
    # The last row: few rows of one prefix are sorted, or those of a single hash.
    last = same.select(order.alias("_order")).orderBy("_order").limit(left).agg(F.max("_order"), F.count(F.lit(1))).first()[0]
    at = F.struct(F.lit(last["_hash"]).alias("_hash"), F.lit(last["_key"]).cast(df.schema[key].dataType).alias("_key"))
    before, ties = same.where(order < at).count(), hashed.where(order == at)
    if before + ties.count() == left:
        return hashed.where(order <= at).drop("_hash")
    return hashed.where(order < at).unionByName(ties.limit(left - before)).drop("_hash")  # rows that repeat the last key


# --- permutations ---------------------------------------------------------------------------------------


def permuted(index: str, n: int, seed: int) -> Column:
    """The place of ``index``, a column or SQL expression, in a permutation of ``0 .. n - 1`` that the seed fixes; every place is taken once.

    A Feistel network permutes the numbers of just enough bits: in turn, one half of the bits is changed by a function of the other half
    and of a key. Places beyond ``n`` are permuted again until they fall below it; half of all are below it at least.
    """
    if n > 1 << 62:
        raise ValueError("a range has at most 2 ** 62 numbers")
    bits = max(2, (n - 1).bit_length())
    low = bits // 2
    keys = ", ".join(f"struct({k % 2} as half, {a}L as a, {b}L as b)" for k, (a, b) in enumerate(round_keys(seed)))
    left, right = (f"shiftright((_s.{other} + _k.b) * _k.a, 20) & {(1 << size) - 1}L" for other, size in (("r", bits - low), ("l", low)))

    def network(value: str) -> str:
        halves = f"struct(shiftright({value}, {low}) as l, {value} & {(1 << low) - 1}L as r)"
        change = f"if(_k.half = 0, struct(_s.l ^ ({left}) as l, _s.r as r), struct(_s.l as l, _s.r ^ ({right}) as r))"
        return f"aggregate(array({keys}), {halves}, (_s, _k) -> {change}, _s -> shiftleft(_s.l, {low}) | _s.r)"

    def walk(value: str, steps: int) -> str:
        return f"aggregate(sequence(1, {steps}), {value}, (_v, _step) -> if(_v < {n}L, _v, {network('_v')}))"

    # Few rows need the second walk, and one that is longer still has a chance of one in 2 ** 128.
    problem = "cast(raise_error('a place was not found in time') as bigint)"
    first = f"transform(array(cast({index} as bigint)), _i -> {network('_i')})"
    second = f"transform({first}, _f -> {walk('_f', 8)})"
    third = f"transform({second}, _f -> if(_f < {n}L, _f, {walk('_f', 128)}))"
    return F.expr(f"transform({third}, _f -> if(_f < {n}L, _f, {problem}))[0]")


def range_permutation(spark: SparkSession, start: int, stop: int, step: int = 1, seed: int = 0) -> DataFrame:
    """``(position, value)``: ``(stop - start) // step`` numbers from ``start`` on, each once, in an order that the seed fixes.

    Every row is worked out by itself from its position: nothing is shuffled, sorted or kept.
    """
    n = max(0, (stop - start) // step)
    return spark.range(n).select(F.col("id").alias("position"), (permuted("id", n, seed) * F.lit(step) + F.lit(start)).alias("value"))


def round_keys(seed: int, rounds: int = 6) -> list[tuple[int, int]]:
    """An odd factor of 30 bits and a summand of 31 for every round."""
    out = []
    for k in range(rounds):
        digest = hashlib.sha256(f"{seed}:{k}".encode()).digest()
        out.append((int.from_bytes(digest[:4], "big") >> 2 | 1 | 1 << 29, int.from_bytes(digest[4:8], "big") >> 1))
    return out


# --- splits ---------------------------------------------------------------------------------------------


def split_bounds(top: int) -> dict[str, tuple[int, int]]:
    """Id ranges, both ends included: 70 % training, then test (one id more than 20 %), then validation."""
    train_end = int(top * 0.7)
    test_end = train_end + 1 + int(top * 0.2)
    return {"train": (1, train_end), "test": (train_end + 1, test_end), "validation": (test_end + 1, top)}


def split_by_id(points: DataFrame, *, fraction: float = 1.0, top: int | None = None) -> DataFrame:
    """Adds ``split`` to the rows of the leading fraction of the id range."""
    if top is None:
        top = int((max_id(points).first()[0] or 0) * fraction)
    bounds = split_bounds(top)
    inside = F.col("id") >= 1
    part = (
        F.when(F.col("id") <= bounds["train"][1], "train")
        .when(F.col("id") <= bounds["test"][1], "test")
        .otherwise("validation")
    )
    return points.where(inside & (F.col("id") <= top)).withColumn("split", part)


def dataset_length(points: DataFrame, excluded: DataFrame, first_id: int, last_id: int) -> DataFrame:
    """Rows in the id range that are not excluded."""
    left_out = excluded.where(id_between(first_id, last_id))
    return without_ids(points.where(id_between(first_id, last_id)).select("id"), left_out).agg(
        F.count(F.lit(1)).alias("n")
    )


# --- remap ----------------------------------------------------------------------------------------------


def check_dense(points: DataFrame, first_id: int, last_id: int) -> None:
    """The remap presumes that every id of the range exists once."""
    each = points.where(id_between(first_id, last_id)).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    ids, most = each.agg(F.count(F.lit(1)), F.max("n")).first()
    if ids != last_id - first_id + 1 or (most or 1) > 1:
        raise ValueError(f"ids {first_id}..{last_id} are not dense: {ids} different ids, one up to {most} times")


def remap_indices(indices: DataFrame, excluded: DataFrame, first_id: int, last_id: int) -> DataFrame:
    """``(idx, id)``: dense indices to kept ids.

    Index ``i`` stands for ``first_id + i``. An excluded id at position ``p`` of the sorted exclusions is
    replaced by the id ``p`` places into the tail of the range, again and again until a kept id is met.
    Chains are resolved for all exclusions at once by pointer jumping, in a logarithmic number of rounds.
    Negative indices count from the end; anything else outside raises.
    """
    listed = excluded.where(id_between(first_id, last_id)).select("id").distinct()
    ranked = pin(dense_index(listed, ["id"], "pos"))
    kept = (last_id - first_id + 1) - ranked.count()
    tail = first_id + kept
    hops = ranked.select("id", "pos", (F.col("pos") + F.lit(tail)).alias("target"))
    onward = ranked.select(F.col("id").alias("target"), F.col("pos").alias("next"))
    chain = pin(hops.join(onward, "target", "left").select("id", "pos", "target", "next"))
    # Only chains that start in front of the tail are asked for, and these end. Exclusions inside the tail may
    # replace one another in a circle that no index reaches.
    while not chain.where((F.col("id") < tail) & F.col("next").isNotNull()).isEmpty():
        ahead = chain.select(
            F.col("pos").alias("next"), F.col("target").alias("_target"), F.col("next").alias("_next")
        )
        chain = pin(
            chain.join(ahead, "next", "left").select(
                "id", "pos", F.coalesce("_target", "target").alias("target"), F.col("_next").alias("next")
            )
        )
    moved = chain.where(F.col("id") < tail).select("id", "target")
    problem = F.raise_error(F.concat(F.lit("index out of range: "), F.col("idx").cast("string"))).cast("long")
    place = (
        F.when((F.col("idx") >= kept) | (F.col("idx") < -kept), problem)
        .when(F.col("idx") < 0, F.col("idx") + F.lit(kept + first_id))
        .otherwise(F.col("idx") + F.lit(first_id))
    )
    return (
        indices.withColumn("id", place)
        .join(broadcast_if_small(moved), "id", "left")
        .select(*indices.columns, F.coalesce("target", "id").cast("long").alias("id"))
    )


# --- training rows --------------------------------------------------------------------------------------


def labelled_rows(
    points: DataFrame,
    cells: DataFrame,
    *,
    first_id: int = 1,
    last_id: int | None = None,
    smoothing: bool = False,
    classes: DataFrame | None = None,
    cut: str = "raise",
) -> tuple[DataFrame, DataFrame]:
    """Rows of an id range with their class, and the sparse label matrix of those rows.

    Points of sparse leaves are left out (they are the excluded ids). Points of cells that are too full and could not be
    split further have no class: ``cut`` is ``raise`` for an error when there are any, or ``drop``. ``last_id``
    defaults to the last id of the table.
    """
    if last_id is None:
        last_id = max_id(points).first()[0] or 0
    classes = pin(active_cells(cells)) if classes is None else classes
    rows = with_cell(points.where(id_between(first_id, last_id)), leaf_lookup(cells, classes))
    if cut == "raise":
        problem = F.raise_error(F.lit("a point in a cell that is too full and cannot be split")).cast("int")
        rows = rows.withColumn("class_idx", F.when(F.col("cut"), problem).otherwise(F.col("class_idx")))
    elif cut != "drop":
        raise ValueError("cut must be 'raise' or 'drop'")
    rows = rows.where("class_idx is not null").drop("cut")
    return rows, smoothed_labels(rows, classes) if smoothing else one_hot(rows)
