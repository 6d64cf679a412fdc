"""Key semantics: first-wins and last-wins loads, deletes, and skew-safe joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def _all_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """One row per key by an aggregate over ``(order, other columns)``.

    Equal orders are decided by the other columns, so the result does not depend
    on the arrival of rows; only rows with a map column, which has no order, are
    chosen by ``order`` alone.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    row = F.struct(*[c for c in [*order, *rest] if c not in keys] or [F.lit(0).alias("_")])
    if any("map<" in kind for name, kind in df.dtypes if name in rest):
        chosen = (F.max_by if last else F.min_by)(row, F.struct(*order))
    else:
        chosen = (F.max if last else F.min)(row)
    picked = df.groupBy(*keys).agg(chosen.alias("_row"))
    return picked.select(*[F.col(c if c in keys else f"_row.{c}") for c in df.columns])


def first_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], null_keys: bool = True
) -> DataFrame:
    """One row per key: the lowest by ``order``.

    Written as an aggregate, so each map task reduces its share of a hot key to
    one row before the shuffle. Rows with a NULL in the key never conflict and
    all stay; pass ``null_keys=False`` when the key columns cannot be NULL.
    Select the needed columns first: the chosen row is carried whole. The input is
    made once, unless it has a map column.
    """
    if not null_keys:
        return _pick(df, keys, order, last=False)
    if any("map<" in kind for _, kind in df.dtypes):  # a map can be no key
        picked = _pick(df.where(_all_set(keys)), keys, order, last=False)
        return picked.unionByName(df.where(~_all_set(keys)))
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*order, *[c for c in rest if c not in order], F.lit(0).alias("_"))
    # equal rows without a whole key are one group, given back as often as they came; as text 0.0 is not -0.0
    plain = [
        F.col(n).cast("string").alias(n) if kind in ("float", "double") else F.col(n)
        for n, kind in df.dtypes if n in rest
    ]
    alone = F.when(~_all_set(keys), F.struct(*plain, F.lit(0).alias("_")))
    picked = df.withColumn("_alone", alone).groupBy(*keys, "_alone").agg(F.min(row).alias("_row"), F.count("*").alias("_n"))
    times = F.when(F.col("_alone").isNull(), 1).otherwise(F.col("_n").cast("int"))
    again = picked.select(*keys, F.explode(F.array_repeat("_row", times)).alias("_row"))
    return again.select(*[F.col(c if c in keys else f"_row.{c}") for c in df.columns])


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the highest by ``order``. NULL is a key value like any other."""
    return _pick(df, keys, order, last=True)


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows of ``batch`` to append: first per key and not yet in ``target``."""
    stored = target.where(_all_set(keys)).select(*keys)
    keyed = first_wins(batch.where(_all_set(keys)), keys, order, null_keys=False)
    new = keyed.join(stored, list(keys), "left_anti").select(*batch.columns)
    return new.unionByName(batch.where(~_all_set(keys)))  # a NULL key never conflicts


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``target`` after writing ``batch`` over it, the latest batch row winning."""
    both = target.withColumn("_batch", F.lit(0)).unionByName(batch.withColumn("_batch", F.lit(1)))
    return last_wins(both, keys, ["_batch", *order]).drop("_batch")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which ``condition`` is not true (unknown counts as not true)."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def delete_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not listed in ``ids``."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread_on: Sequence[str] = (),
    rows_per_task: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi join in which a few keys may hold most rows of ``big``.

    ``small`` has at most one row per key. Keys above ``rows_per_task`` (a million) rows are
    counted first (a pre-aggregated pass over the key columns only); their rows
    in ``big`` are spread over as many salts as they need by a hash of
    ``spread_on``, and only the matching rows of ``small`` are repeated. All such
    keys are split; they number at most the rows of ``big`` over ``rows_per_task``,
    one in a million, which bounds the list that is broadcast. Pass ``counts`` (some or all keys and ``_n``)
    when ``big`` is costly to make: a count over a larger table, or by fewer keys,
    serves as well. Rows with a NULL key cannot match and are
    spread as well, so an outer join does not pile them up in one task.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    keys = list(keys)
    spread_on = list(spread_on) or [n for n, t in big.dtypes if "map<" not in t]
    if counts is None:
        counts = big.where(_all_set(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    counted = [k for k in keys if k in counts.columns]
    hot = F.broadcast(
        counts.where(F.col("_n") > rows_per_task)
        .select(*counted, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )
    digest = F.xxhash64(*spread_on)
    left = big.join(hot, counted, "left").withColumn(
        "_salt",
        F.when(~_all_set(keys), F.pmod(digest, F.lit(1024)))
        .otherwise(F.pmod(digest, F.coalesce("_salts", F.lit(1))))
        .cast("int"),
    )
    right = small.join(hot, counted, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return left.drop("_salts").join(right.drop("_salts"), [*keys, "_salt"], how).drop("_salt")
