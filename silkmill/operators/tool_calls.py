"""Checks and prompts of function-calling examples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def call_is_valid(function: Column, call: Column) -> Column:
    """The call names the function and gives all required arguments; anything missing makes it false."""
    required = F.coalesce(F.filter(function["parameters"]["required"], lambda r: r.isNotNull()), F.array().cast("array<string>"))
    given = F.coalesce(F.map_keys(call["arguments"]), F.array().cast("array<string>"))
    # an absent parameters part is no list of required arguments, so it fails as a missing key does
    complete = F.size(F.array_except(required, given)) == 0
    return F.coalesce((function["name"] == call["function_name"]) & function["parameters"]["required"].isNotNull() & call["arguments"].isNotNull() & complete, F.lit(False))


def calls_are_valid(functions: Column, calls: Column) -> Column:
    """Every call at the place of its function, as many of one as of the other, and at least one."""
    pairs = F.arrays_zip(functions.alias("f"), calls.alias("c"))
    return F.coalesce((F.size(functions) == F.size(calls)) & (F.size(calls) > 0) & F.forall(pairs, lambda p: call_is_valid(p["f"], p["c"])), F.lit(False))
