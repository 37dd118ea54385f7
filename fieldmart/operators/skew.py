"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.limits import DEFAULT, Limits
from fieldmart.operators.sizing import fits
from fieldmart.session import in_buckets, pin, tune

NULL_SPREAD = 1 << 16  # rows with a NULL key match nothing and may lie anywhere

GRID_ROWS = 10_000  # hot keys that are always broadcast
SALT = 256  # copies of a table of hot keys too large to broadcast


def heavy_keys(sides: list[DataFrame], limits: Limits = DEFAULT, null_is_heavy: bool = False) -> DataFrame | None:
    """The hot keys that `weighed` finds."""
    return weighed(sides, limits, null_is_heavy)[1]


def weighed(
    sides: list[DataFrame], limits: Limits = DEFAULT, null_is_heavy: bool = False
) -> tuple[list[int], DataFrame | None]:
    """The rows of each side, and the hot keys: those held by more than limits.hot_rows rows, on some side or after the sides are joined,
    with the rows per side; None if there is no such key.

    Each side holds the key columns only, under the same names. Rows are counted by buckets of keys, and
    keys one by one only in buckets that are full, so nearly unique keys are not grouped. The hot keys are
    a written table: there are at most as many as limits.hot_rows goes into all rows, and none is left
    out. They never reach the driver. A key that is NULL is never joined; with `null_is_heavy` it counts
    as hot as soon as the first side has it.
    """
    keys = sides[0].columns
    names = [f"rows_{i}" for i in range(len(sides))]
    tagged = reduce(
        DataFrame.unionByName,
        [
            df.select(*keys, *[F.lit(1 if i == j else 0).alias(n) for j, n in enumerate(names)])
            for i, df in enumerate(sides)
        ],
    )
    sums = [F.sum(n).alias(n) for n in names]
    # As decimals and doubles would, so that large counts do not overflow.
    joined = reduce(Column.__mul__, [F.greatest(F.col(n), F.lit(1)).cast("double") for n in names])
    largest = F.greatest(*[F.col(n).cast("double") for n in names], joined) if len(names) > 1 else joined
    alone = F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])
    # A bucket has at least the rows of each of its keys, so keys need counting only in full buckets.
    bucket = F.pmod(F.xxhash64(*keys), F.lit(limits.count_buckets)).cast("int")
    heavy = largest > limits.hot_rows
    nulls = []
    if null_is_heavy:
        nulls = [F.max(_any_null(keys) & (F.col("rows_0") == 1)).alias("__null")]
        heavy = heavy | F.col("__null")
    buckets = pin(tagged.groupBy(bucket.alias("__bucket")).agg(*sums, *nulls))
    *rows, full = buckets.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in names], F.count_if(heavy)).first()
    if not full:
        return rows, None
    # At most limits.count_buckets numbers.
    full = F.broadcast(buckets.where(heavy).select("__bucket"))
    inside = tagged.withColumn("__bucket", bucket).join(full, "__bucket", "left_semi")
    counts = inside.groupBy(*keys).agg(*sums)
    size = F.when(_any_null(keys), alone.cast("double")).otherwise(largest)
    heavy = size > limits.hot_rows
    if null_is_heavy:
        heavy = heavy | (_any_null(keys) & (F.col("rows_0") > 0))
    hot = pin(counts.where(heavy))
    return rows, None if hot.isEmpty() else hot


def together(df: DataFrame, rows: int, *keys: str, limits: Limits = DEFAULT) -> DataFrame:
    """df, of about so many rows, shuffled by key columns into parts of about limits.task_rows rows. None may be hot."""
    if rows <= limits.hot_rows:
        return df.repartition(*keys)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // limits.task_rows)), *keys)


def distinct_by(df: DataFrame, rows: int | None = None, *keys: str, limits: Limits = DEFAULT) -> DataFrame:
    """The distinct rows of df, which stay where the key columns (all, if none is named) have brought them.

    A distinct that starts before its shuffle holds all different rows of a task's input, and a small file can
    become very many of them. After the shuffle a task holds its part alone. `rows` are counted if not given.
    """
    rows = df.count() if rows is None else rows
    return together(df, rows, *(keys or df.columns), limits=limits).distinct()


def distinct_in_place(df: DataFrame) -> DataFrame:
    """The distinct rows of wide rows, of which only those are shuffled that may be there more than once.

    df is written once, where its tasks make the rows. A hash of each row and the number of its task travel; a row
    whose hash no other has stays where it lies, the others are brought together and compared whole. A row counts
    once a task, so that one that is there very often travels as often as there are tasks.
    """
    tune(df.sparkSession)  # rows stay for all keys that contain their task
    # As a distinct gives them: 0.0 for -0.0.
    floating = {c: (F.col(f"`{c}`") + F.lit(0)).cast(kind) for c, kind in df.dtypes if kind in ("double", "float")}
    df = df.withColumns(floating) if floating else df
    columns = [F.col(f"`{c}`") for c in df.columns]
    rows = in_buckets(df.withColumn("__part", F.spark_partition_id()), "__part")
    hashed = rows.withColumn("__hash", _row_hash(df))
    counts = hashed.groupBy("__part", "__hash").agg(F.count("*").alias("__n"))
    everywhere = F.sum("__n").over(Window.partitionBy("__hash"))
    met = counts.withColumn("__n", everywhere).where("__n > 1").select("__part", "__hash").hint("shuffle_hash")
    alone, several = (hashed.join(met, ["__part", "__hash"], how).select(*columns) for how in ("left_anti", "left_semi"))
    return alone.unionByName(several.distinct())


def split_hot(
    df: DataFrame, key: str, hot: DataFrame, limits: Limits = DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """The rows of df whose key is not among the hot ones, and those whose key is; NULL is a key like any other.

    A list of hot keys too large to broadcast is copied SALT times and joined by key and salt, so that the
    rows of a hot key do not gather in one task.
    """
    listed = hot.select(hot.columns[0]).toDF("__hot")
    same = F.col(key).eqNullSafe(F.col("__hot"))
    if few(listed, limits):
        listed, salted = F.broadcast(listed), df
    else:
        salts = F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))
        listed = listed.withColumn("__copy", F.explode(salts))
        salted = df.withColumn("__salt", F.pmod(_row_hash(df), F.lit(SALT)))
        same = same & (F.col("__salt") == F.col("__copy"))
    return tuple(salted.join(listed, same, how).drop("__salt") for how in ("left_anti", "left_semi"))


def few(hot: DataFrame, limits: Limits) -> bool:
    """Whether a written table of hot keys may be broadcast."""
    return hot.limit(GRID_ROWS + 1).count() <= GRID_ROWS or fits(hot, limits)


def _any_null(keys: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _cells(rows: Column, limits: Limits) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / F.lit(limits.hot_rows))).cast("int")


def _grid(hot: DataFrame, keys: list[str], one_column: bool, limits: Limits) -> DataFrame:
    """The lines and columns of each hot key: so many that a cell joins to about limits.hot_rows rows."""
    left, right = F.col("rows_0").cast("double"), F.greatest(F.col("rows_1"), F.lit(1)).cast("double")
    columns = F.lit(1) if one_column else _cells(right, limits)
    lines = _cells(left * F.ceil(right / columns), limits)
    lines = F.least(lines, F.greatest(F.col("rows_0"), F.lit(1))).cast("int")
    return hot.select(*keys, lines.alias("__lines"), columns.alias("__columns"))


def _with_grid(df: DataFrame, grid: DataFrame, keys: list[str], small: bool, scatter: Column) -> DataFrame:
    """Lines and columns of each row, 1 and 1 for keys that are not hot. A grid too large to broadcast
    is copied SALT times, so that a hot key does not gather in one task here either."""
    one = F.lit(1)
    if small:
        found = df.join(F.broadcast(grid), keys, "left")
    else:
        salted = grid.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
        found = df.withColumn("__salt", F.pmod(scatter, F.lit(SALT))).join(salted, [*keys, "__salt"], "left")
        found = found.drop("__salt")
    return found.withColumns({"__lines": F.coalesce("__lines", one), "__columns": F.coalesce("__columns", one)})


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    residual: Column | None = None,
    hot: DataFrame | None = None,
    counted: bool = False,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """left LEFT JOIN right ON the key columns (same names on both sides) AND residual.

    Rows with a NULL key are scattered. A key with many rows becomes a grid of cells: left rows
    go to one line of cells, right rows to one column, so each pair meets exactly once and no
    task holds a whole hot group. The residual may use columns of both sides; with it a left row
    is never copied, as its cell alone must tell whether it has a match.

    `hot` is the result of heavy_keys for the two sides, its key columns in the order of `keys`, where
    the caller can get it from less than the whole of `left`; `counted` says that None means
    there is none. Every hot key must be counted on the right side as it is there.
    """
    if hot is None and not counted:
        hot = heavy_keys([left.select(*keys), right.select(*keys)], limits)
    right = right.where(~_any_null(keys))
    row_hash = _row_hash(left)
    line = F.when(_any_null(keys), F.pmod(row_hash, F.lit(NULL_SPREAD)))
    if hot is None:
        left = left.withColumn("__line", line.otherwise(F.lit(0)))
        right = right.withColumn("__line", F.lit(0).cast("long"))
        return _joined(left, right, [*keys, "__line"], residual).drop("__line")

    hot = hot.withColumnsRenamed(dict(zip(hot.columns, keys, strict=False))).where(~_any_null(keys))
    grid = _grid(hot, keys, residual is not None, limits)
    small = few(grid, limits)
    left = (
        _with_grid(left, grid, keys, small, row_hash)
        .withColumn("__line", line.otherwise(F.pmod(row_hash, F.col("__lines"))))
        .withColumn("__column", F.explode(F.sequence(F.lit(0), F.col("__columns") - 1)))
        .drop("__lines")
    )
    payload = right.columns
    # Copies of one right row travel as a count, in pieces no larger than the limit.
    right = right.groupBy(*payload).agg(F.count("*").alias("__copies"))
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / F.lit(limits.hot_rows)))
    right = (
        right.withColumn("__piece", F.explode(pieces))
        .withColumn(
            "__copies",
            F.least(F.lit(limits.hot_rows), F.col("__copies") - F.col("__piece") * F.lit(limits.hot_rows)),
        )
    )
    right = (
        _with_grid(right, grid, keys, small, F.xxhash64(*payload, "__piece"))
        .withColumn(
            "__column",
            F.pmod(F.xxhash64(*payload, "__piece"), F.col("__columns")).cast("int"),
        )
        .withColumn("__line", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("__lines") - 1).cast("long"))))
        .drop("__lines", "__columns", "__piece")
    )
    joined = _joined(left, right, [*keys, "__line", "__column"], residual)
    # A left row was copied only for a key the right side has, so a real match exists elsewhere.
    met = F.col("__copies").isNotNull()
    return (
        joined.where((F.col("__columns") == 1) | met)
        .withColumn("__copies", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("__copies", F.lit(1)))))
        .drop("__line", "__column", "__columns", "__copies")
    )


def _joined(left: DataFrame, right: DataFrame, keys: list[str], residual: Column | None) -> DataFrame:
    if residual is None:
        return left.join(right, keys, "left")
    renamed = {k: f"__right_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(renamed)
    condition = reduce(Column.__and__, [F.col(k) == F.col(r) for k, r in renamed.items()], residual)
    return left.join(right, condition, "left").drop(*renamed.values())
