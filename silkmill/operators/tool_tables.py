"""Function-calling examples as related flat tables, by columnar shredding.

One table per repeated ancestor: functions, the properties of their parameters, their required
entries, calls, the arguments of calls and the review texts among them. (example_id, function_no) and
(example_id, call_no) link the children to their parents. Rows delivered twice are there once; where
deliveries differ in a value, the greater row stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkmill.operators.shredding import LeafPath, rebuild, rebuild_table, shred, shred_raw

REQUIRED = LeafPath("function[].parameters.required[]")
REVIEW = LeafPath("input_parameters[].arguments.user_review[]", own="text")
FUNCTIONS = {c: LeafPath(f"function[].{p}") for c, p in (("name", "name"), ("description", "description"), ("parameters_type", "parameters.type"))}
PROPERTIES = {c: LeafPath("function[].parameters.properties{}." + p) for c, p in (("property", "key"), ("type", "value.type"), ("description", "value.description"))}
CALLS = {"function_name": LeafPath("input_parameters[].function_name")}
ARGUMENTS = {c: LeafPath("input_parameters[].arguments{}." + p) for c, p in (("argument", "key"), ("value", "value"))}


def _function(*fields: Column) -> Column:
    return F.transform("function", lambda f: F.when(f.isNotNull(), F.struct(*[make(f) for make in fields])))


def _parameters(f: Column, *names: str) -> Column:
    return F.when(f["parameters"].isNotNull(), F.struct(*[f["parameters"][n].alias(n) for n in names])).alias("parameters")


def example_levels(examples: DataFrame, raw_outputs: DataFrame | None, columns: dict[str, Column], paths: list[LeafPath]) -> DataFrame:
    """Level rows of the structured examples and of those inside raw model outputs. ``columns``: the nested parts that
    ``paths`` name; nothing else leaves the JVM."""
    levels = shred(examples, "example_id", columns, paths)
    return levels if raw_outputs is None else levels.unionByName(shred_raw(raw_outputs, "raw", "example_id", paths))


def child_items(examples: DataFrame, raw_outputs: DataFrame | None) -> DataFrame:
    """(example_id, list_name, parent_no, child_no, item) of the required entries and the review texts, each once.

    Null entries keep their position and give no row; neither do blank review texts.
    """
    review = F.transform("input_parameters", lambda p: F.when(p.isNotNull(), F.struct(F.map_filter(p["arguments"], lambda k, _: k == "user_review").alias("arguments"))))
    columns = {"function": _function(lambda f: _parameters(f, "required")), "input_parameters": review}
    rows = rebuild(example_levels(examples, raw_outputs, columns, [REQUIRED, REVIEW]), [REQUIRED, REVIEW])
    is_review = F.col("path") == REVIEW.text
    kept = rows.where(~is_review | F.col("value").rlike(r"[^\s\p{Z}]"))
    list_name = F.when(is_review, "user_review").otherwise("required")
    return kept.select(F.col("record_id").alias("example_id"), list_name.alias("list_name"), F.col("pos_0").alias("parent_no"), F.col("pos_1").alias("child_no"), F.col("value").alias("item")).distinct()


def _table(examples: DataFrame, raw_outputs: DataFrame | None, columns: dict[str, Column], paths: dict[str, LeafPath], keys: list[str]) -> DataFrame:
    rows = rebuild_table(example_levels(examples, raw_outputs, columns, list(paths.values())), paths)
    named = [F.col("record_id").alias("example_id"), *[F.col(f"pos_{k}").alias(name) for k, name in enumerate(keys)]]
    return rows.groupBy(*named).agg(F.max(F.struct(*paths)).alias("_r")).select("example_id", *keys, "_r.*")


def function_table(examples: DataFrame, raw_outputs: DataFrame | None) -> DataFrame:
    """(example_id, function_no, name, description, parameters_type): one row per function slot that is not null."""
    columns = {"function": _function(lambda f: f["name"].alias("name"), lambda f: f["description"].alias("description"), lambda f: _parameters(f, "type"))}
    return _table(examples, raw_outputs, columns, FUNCTIONS, ["function_no"])


def property_table(examples: DataFrame, raw_outputs: DataFrame | None) -> DataFrame:
    """(example_id, function_no, property_no, property, type, description): one row per property of a function's parameters."""
    return _table(examples, raw_outputs, {"function": _function(lambda f: _parameters(f, "properties"))}, PROPERTIES, ["function_no", "property_no"])


def call_table(examples: DataFrame, raw_outputs: DataFrame | None) -> DataFrame:
    """(example_id, call_no, function_name): one row per call slot that is not null."""
    columns = {"input_parameters": F.transform("input_parameters", lambda p: F.when(p.isNotNull(), F.struct(p["function_name"].alias("function_name"))))}
    return _table(examples, raw_outputs, columns, CALLS, ["call_no"])


def argument_table(examples: DataFrame, raw_outputs: DataFrame | None) -> DataFrame:
    """(example_id, call_no, argument_no, argument, value): one row per argument of a call; a value that is no text is its JSON text."""
    columns = {"input_parameters": F.transform("input_parameters", lambda p: F.when(p.isNotNull(), F.struct(p["arguments"].alias("arguments"))))}
    return _table(examples, raw_outputs, columns, ARGUMENTS, ["call_no", "argument_no"])
