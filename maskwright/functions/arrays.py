"""Helpers for Spark's higher-order array functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
_ENTRY = (1 << 31) - 1


def evaluated_once(df: DataFrame, columns: Column | dict[str, Column]) -> DataFrame:
    """Add columns (or a struct's fields) that no later filter can copy.

    Spark pushes a filter below a projection by putting the projected expressions into the
    filter's condition, however costly they are, and then evaluates them in both places. It
    never does that with the output of a generator, so the columns come from one that gives
    exactly one row. Filters on the other columns still reach the scan.
    """
    record = (
        F.struct(*[c.alias(name) for name, c in columns.items()])
        if isinstance(columns, dict)
        else columns
    )
    return df.select("*", F.inline(F.array(record)))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it as often as ``body`` likes."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def blocks(items: Column, size: int = BLOCK) -> Column:
    """Cut an array column into an array of arrays of at most ``size`` elements."""
    starts = F.when(
        F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1, F.lit(size))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(items, s + 1, F.lit(size)))


def running(
    items: Column,
    zero: Column,
    step: Callable[[Column, Column], Column],
    emit: Callable[[Column, Column], Column],
    out_type: str,
) -> Column:
    """Carry a state over an array and return what ``emit(state, item)`` gave for each item.

    ``aggregate`` copies its accumulator for each item, so one pass over n items costs n*n.
    Here each block of items has an accumulator of its own, and only finished blocks are added
    to the outer one.
    """
    empty = F.array().cast(f"array<{out_type}>")
    none_yet = F.array().cast(f"array<array<{out_type}>>")

    def one(acc: Column, item: Column) -> Column:
        return F.struct(
            step(acc["state"], item).alias("state"),
            F.array_append(acc["block"], emit(acc["state"], item)).alias("block"),
        )

    def one_block(outer: Column, block: Column) -> Column:
        def close(acc: Column) -> Column:
            return F.struct(
                acc["state"].alias("state"),
                F.array_append(outer["done"], acc["block"]).alias("done"),
            )

        start = F.struct(outer["state"].alias("state"), empty.alias("block"))
        return F.aggregate(block, start, one, close)

    def by_block(bound: Column) -> Column:
        start = F.struct(zero.alias("state"), none_yet.alias("done"))
        return F.flatten(
            F.aggregate(blocks(bound), start, one_block, lambda acc: acc["done"])
        )

    return bind(items, by_block)


def looked_up(
    items: Column,
    asked_for: str,
    after: str,
    table: Column,
    key: str,
    value: str,
    key_type: str,
    value_type: str,
) -> Column:
    """For each item the first table entry with its key that lies behind a place of its own.

    ``asked_for`` is the field of an item that holds the key (null: no entry), ``after`` the one
    that holds the place, an index into the table or -1. The result has the fields ``at``, the
    entry's index or null, and ``value``, in the order of the items.

    Spark looks keys up in maps and arrays by walking them, which is quadratic for many items. Here
    items and entries are sorted together, entries that lie further back first, and the last entry
    passed is carried along.
    """
    record = f"struct<key:{key_type},place:int,item:int,value:{value_type}>"
    entries = F.transform(
        table,
        lambda e, i: F.struct(
            e[key].alias("key"), (-i).alias("place"), F.lit(_ENTRY).alias("item"), e[value].alias("value")
        ).cast(record),
    )
    asked = F.transform(
        items,
        lambda t, i: F.struct(
            t[asked_for].alias("key"), (-t[after]).alias("place"), i.alias("item"),
            F.lit(None).cast(value_type).alias("value"),
        ).cast(record),
    )
    none = F.lit(None).cast(f"struct<key:{key_type},at:int,value:{value_type}>")
    found_type = f"struct<item:int,at:int,value:{value_type}>"

    def step(last: Column, x: Column) -> Column:
        entry = F.struct(x["key"].alias("key"), (-x["place"]).alias("at"), x["value"].alias("value"))
        return F.when(x["item"] == _ENTRY, entry).otherwise(last)

    def emit(last: Column, x: Column) -> Column:
        same = last["key"] == x["key"]
        found = F.struct(
            x["item"].alias("item"), F.when(same, last["at"]).alias("at"),
            F.when(same, last["value"]).alias("value"),
        )
        return F.when(x["item"] < _ENTRY, found)

    # An item sorts before the entry of its own place, which is not behind it.
    answers = running(F.array_sort(F.concat(entries, asked)), none, step, emit, found_type)
    return F.array_sort(F.filter(answers, lambda a: a.isNotNull()))
