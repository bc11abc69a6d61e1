"""Query programs: a nested struct column, and the seeded generator that makes them.

Fields are in alphabetical order at each level, so that to_json gives the sorted-key JSON that hashes are made of.
The generator draws from CPython's random.Random, one choice per decision in a fixed order, so that a seed means the same
program everywhere; it runs in Python workers over a range of attempts.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsql.functions.keys import stable_hash_py
from loomsql.sources.schemas import Schema, Table

_REF = "struct<alias:string,name:string>"
_PREDICATES = "array<struct<expression:string>>"
PROGRAM = (
    f"struct<base_table:{_REF},dialect:string,group_by:array<string>,having:{_PREDICATES},"
    f"joins:array<struct<join_type:string,on_expression:string,right_table:{_REF}>>,limit:int,"
    "metadata:struct<complexity:string,program_hash:string,schema_id:string>,"
    "order_by:array<struct<direction:string,expression:string>>,"
    "select_items:array<struct<alias:string,expression:string,is_aggregate:boolean>>,"
    f"template_id:string,where_predicates:{_PREDICATES}>"
)
#: Fixed values, in the order in which the generator chooses among them.
COMPLEXITIES = ["easy", "medium", "hard"]
AGGREGATES = ["SUM", "AVG", "MAX", "MIN", "COUNT"]
LIMITS, THRESHOLDS, DIRECTIONS = [10, 25, 50], [0, 1, 5, 10], ["ASC", "DESC"]


def dimensions(table: Table) -> list[str]:
    others = [c for c in table.columns if c.name != table.primary_key]
    wanted = [c.name for c in others if c.data_type in ("text", "date", "timestamp")]
    return wanted or [c.name for c in others] or [table.primary_key]


def metrics(table: Table) -> list[str]:
    numbers = [c for c in table.columns if c.name != table.primary_key and c.data_type in ("decimal", "integer")]
    return [c.name for c in numbers if c.value_strategy != "foreign_key"] or [c.name for c in numbers] or [table.primary_key]


def generate(schema: Schema, *, template_id: str, complexity: str, dialect: str = "ansi_like", seed: int = 0) -> dict:
    """A program as a plain dict. The same seed always gives the same one."""
    if complexity not in COMPLEXITIES:
        raise ValueError(f"Unsupported complexity: {complexity}")
    choose = random.Random(seed).choice
    tables = [choose(list(schema.tables))]
    joins = []

    def join(edges: list) -> None:
        table, column, to, to_column = choose(edges)
        here, here_alias, alias = tables[-1].name, f"t{len(tables)}", f"t{len(tables) + 1}"
        # The referencing side is written first, whichever table is added.
        one, two = (here_alias, alias) if table == here else (alias, here_alias)
        other = schema.table(to if table == here else table)
        joins.append({"join_type": "INNER JOIN", "on_expression": f"{one}.{column} = {two}.{to_column}", "right_table": {"alias": alias, "name": other.name}})
        tables.append(other)

    def touching(name: str) -> list:
        return [e for e in schema.join_graph if name in (e[0], e[2])]

    if complexity != "easy" and touching(tables[0].name):
        join(touching(tables[0].name))
        used = {t.name for t in tables}
        onward = [e for e in touching(tables[-1].name) if not {e[0], e[2]} <= used]
        if complexity == "hard" and onward:
            join(onward)
    dimension = choose(dimensions(tables[0]))
    column = f"t1.{dimension}"
    # An easy query's metric is a plain column of the one table, another's an aggregate over the last one.
    aggregate = complexity != "easy"
    metric = choose(metrics(tables[-1]))
    argument = f"t{len(tables)}.{metric}"
    function = choose(AGGREGATES) if aggregate else None
    value = f"{function}({argument})" if aggregate else argument
    items = [{"alias": dimension, "expression": column, "is_aggregate": False}]
    items.append({"alias": f"{function.lower()}_{metric}" if aggregate else metric, "expression": value, "is_aggregate": aggregate})
    filled = lambda name: {"expression": f"{name} IS NOT NULL"}
    either = lambda: filled(column) if choose([True, False]) else {"expression": f"{column} <> ''"}
    where = [filled(argument)] if aggregate else [either()]
    by = value if choose([True, False]) else column
    order = [{"direction": choose(DIRECTIONS), "expression": by}]
    limit = None if complexity == "hard" else choose(LIMITS)
    having = []
    if complexity == "hard":
        where.append(either())
        having = [{"expression": f"{value} > {choose(THRESHOLDS)}"}]
    program = {
        "base_table": {"alias": "t1", "name": tables[0].name}, "dialect": dialect, "group_by": [column] if aggregate else [], "having": having,
        "joins": joins, "limit": limit, "metadata": {}, "order_by": order, "select_items": items, "template_id": template_id, "where_predicates": where,
    }
    program["metadata"] = {"complexity": complexity, "program_hash": stable_hash_py(program), "schema_id": schema.schema_id}
    return program


def attempts(spark: SparkSession, schemas: list[Schema], complexities: list[str], templates: dict[str, list[str]], seed: int, n: int) -> DataFrame:
    """attempt, schema_family, program of attempts 0 to n - 1: attempt a takes schema a mod schemas, and so on."""

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for a in frame["id"].tolist():
                schema, complexity = schemas[a % len(schemas)], complexities[a % len(complexities)]
                names = templates[complexity]
                program = generate(schema, template_id=names[a % len(names)], complexity=complexity, seed=seed + a)
                rows.append((a, schema.schema_family, json.dumps(program)))
            yield pd.DataFrame(rows, columns=["attempt", "schema_family", "program"])

    out = spark.range(n).mapInPandas(made, "attempt long, schema_family string, program string")
    return out.withColumn("program", F.from_json("program", PROGRAM))


def frame(spark: SparkSession, programs: list[dict]) -> DataFrame:
    rows = [(i, json.dumps(p)) for i, p in enumerate(programs)]
    return spark.createDataFrame(rows, "n long, program string").withColumn("program", F.from_json("program", PROGRAM))
