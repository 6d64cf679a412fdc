"""Folds over the items of an array, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 1000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fold_emitting(
    items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], emitted: str
) -> Column:
    """``struct<state, out>``: a fold whose steps hand on a state and emit a list of ``emitted`` each.

    ``step`` takes the state and an item. Items are taken in blocks of ``BLOCK``, since an array
    that grows is copied at each step: what is emitted is copied within its block only.
    """
    nothing = F.array().cast(f"array<{emitted}>")

    def one(held: Column, item: Column) -> Column:
        state, more = step(held["state"], item)
        return let(
            F.struct(state.alias("state"), more.alias("more")),
            lambda made: F.struct(made["state"].alias("state"), F.concat(held["out"], made["more"]).alias("out")),
        )

    def block(held: Column, items: Column) -> Column:
        return let(
            F.aggregate(items, F.struct(held["state"].alias("state"), nothing.alias("out")), one),
            lambda made: F.struct(
                made["state"].alias("state"), F.concat(held["out"], F.array(made["out"])).alias("out")
            ),
        )

    count = F.ceil(F.size(items) / BLOCK).cast("int")
    firsts = F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: i < count)
    blocks = F.transform(firsts, lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
    empty = F.array().cast(f"array<array<{emitted}>>")
    return F.aggregate(
        blocks, F.struct(start.alias("state"), empty.alias("out")), block,
        lambda held: F.struct(held["state"].alias("state"), F.flatten(held["out"]).alias("out")),
    )
