"""Schema families: loaded from YAML, with join graphs, as driver objects and as DataFrames."""

from __future__ import annotations

import json
import pkgutil
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The Spark type of each declared type.
TYPES = {"integer": "bigint", "text": "string", "decimal": "decimal(18,2)", "date": "date", "timestamp": "timestamp"}


@dataclass(frozen=True)
class Column:
    name: str
    data_type: str
    nullable: bool = False
    description: str = ""
    value_strategy: str = ""


@dataclass(frozen=True)
class ForeignKey:
    column: str
    references_table: str
    references_column: str


@dataclass(frozen=True)
class Table:
    name: str
    primary_key: str
    columns: tuple[Column, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class Schema:
    schema_family: str
    version: str
    tables: tuple[Table, ...]
    description: str = ""
    seed_hints: tuple[str, ...] = ()
    provenance: str = "manual_config_v1"
    schema_id: str = field(default="")

    def __post_init__(self):
        object.__setattr__(self, "schema_id", f"{self.schema_family}_{self.version}")

    @property
    def join_graph(self) -> list[tuple[str, str, str, str]]:
        """(table, column, referenced table, referenced column) in table, then key order."""
        return [(t.name, k.column, k.references_table, k.references_column) for t in self.tables for k in t.foreign_keys]

    def table(self, name: str) -> Table:
        found = {t.name: t for t in self.tables}
        if name not in found:
            raise KeyError(f"Unknown table: {name}")
        return found[name]


def from_dict(said: dict) -> Schema:
    tables = [
        Table(
            t["name"], t["primary_key"], tuple(Column(**c) for c in t.get("columns", [])),
            tuple(ForeignKey(**k) for k in t.get("foreign_keys", [])), t.get("description", ""),
        )
        for t in said["tables"]
    ]
    return Schema(said["schema_family"], said["version"], tuple(tables), said.get("description", ""), tuple(said.get("seed_hints", [])))


def parse_yaml(text: str) -> dict:
    import yaml

    return yaml.safe_load(text)


def read_yaml(path: str | Path) -> dict:
    return parse_yaml(Path(path).read_text())


def load_schema(path: str | Path) -> Schema:
    return from_dict(read_yaml(path))


def load_schemas(paths: list[str]) -> list[Schema]:
    return [load_schema(p) for p in paths]


def to_dict(schema: Schema) -> dict:
    edges = [dict(zip(("left_table", "left_column", "right_table", "right_column"), e, strict=True)) for e in schema.join_graph]
    return asdict(schema) | {"join_graph": edges}


def write_schema(schema: Schema, path: str | Path) -> Path:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(to_dict(schema), indent=2))
    return path


def columns_frame(spark: SparkSession, schemas: list[Schema]) -> DataFrame:
    rows = [(s.schema_id, t.name, i, c.name, c.data_type, c.name == t.primary_key) for s in schemas for t in s.tables for i, c in enumerate(t.columns)]
    return spark.createDataFrame(rows, "schema_id string, table_name string, position long, column_name string, data_type string, is_key boolean")


def edges_frame(spark: SparkSession, schemas: list[Schema]) -> DataFrame:
    rows = [(s.schema_id, i, *e) for s in schemas for i, e in enumerate(s.join_graph)]
    return spark.createDataFrame(rows, "schema_id string, position long, left_table string, left_column string, right_table string, right_column string")


def register_empty_views(spark: SparkSession, schema: Schema) -> None:
    """Empty temp views of the tables, for analysis of generated queries."""
    for t in schema.tables:
        spark.createDataFrame([], ", ".join(f"{c.name} {TYPES[c.data_type]}" for c in t.columns)).createOrReplaceTempView(t.name)


#: The schema families that come with the package.
FAMILIES = [from_dict(parse_yaml(pkgutil.get_data("loomsql", f"families/{name}.yaml").decode())) for name in ("retail_sales", "hr_payroll", "logistics")]
