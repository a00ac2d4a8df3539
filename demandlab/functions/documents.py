"""Text, array and nested-value expressions for reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_reasons(*conditional: Column, separator: str = " | ", default: str | None = None) -> Column:
    """Joins the non-null texts; ``default`` when all are null."""
    text = F.concat_ws(separator, *conditional)
    return text if default is None else F.when(text == "", F.lit(default)).otherwise(text)


def texts_if(conditions: list[tuple[Column, Column]]) -> Column:
    """Array of the texts whose condition holds, in order; a text that is null is left out.

    Arrays of one text or none are joined: a filter with a lambda would leave Spark's compiled code, with
    every expression below it.
    """
    none, null = F.array().cast("array<string>"), F.array(F.lit(None).cast("string"))
    return F.concat(none, *[F.when(cond, F.array_except(F.array(text), null)).otherwise(none) for cond, text in conditions])


def nested_or(path: str, default) -> Column:
    return F.coalesce(F.col(path), F.lit(default))


def as_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def two_decimals(x: Column) -> Column:
    """A non-negative double with two decimals, rounded on its exact binary value.

    ``format_string`` rounds the shortest decimal text instead, so 5.255, which is
    stored slightly below that, would become 5.26. What is after the point, scaled by a
    power of two, is an integer without loss, and a hundred times that fits a long.
    """

    def hundredths(bits: int) -> Column:
        scaled = ((x - F.floor(x)) * float(2**bits)).cast("bigint") * 100
        to_even = F.shiftright(scaled, bits).bitwiseAND(1)
        return F.floor(x) * 100 + F.shiftright(scaled + (2 ** (bits - 1) - 1) + to_even, bits)

    # Doubles from 1/16 on are multiples of 2**-56; below it 60 bits are as many as a long takes.
    found = F.when(x < 0.0625, hundredths(60)).otherwise(hundredths(56))
    exact = (found.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("string")
    return F.when(x < 2**42, exact).otherwise(F.format_string("%.2f", x))
