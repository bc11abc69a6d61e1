"""Command line: release bundles, schema files and single examples. `python -m loomsql.cli --help` lists the commands."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from loomsql.functions import programs as P
from loomsql.operators.validate import parse_sql
from loomsql.plans import corpus, program
from loomsql.sources import export, schemas


def _values(spark: SparkSession, made: dict, **columns: Column) -> dict:
    return program.frame(spark, [made]).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def _made(args: argparse.Namespace) -> tuple[schemas.Schema, dict]:
    schema = schemas.load_schema(args.schema_config)
    return schema, program.generate(schema, template_id=args.template_id, complexity=args.complexity, seed=args.seed)


def release(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    config = schemas.read_yaml(args.config_path) if args.config_path else corpus.RELEASE
    families = None if args.config_path else schemas.FAMILIES
    return list(corpus.build_release(spark, config, args.output_dir, families).values())


def schema(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    found = schemas.load_schema(args.schema_config)
    return [str(schemas.write_schema(found, Path(args.output_dir) / f"{found.schema_id}.json"))]


def clean(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    _, made = _made(args)
    return [_values(spark, made, sql=P.render(F.col("program")))["sql"]]


def corrupt(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    found, made = _made(args)
    p, family = F.col("program"), F.lit(found.schema_family)
    said = _values(spark, made, fits=P.applies(p, args.operator), source=P.corrupted_sql(p, args.operator, family), target=P.render(p))
    if not said["fits"]:
        raise ValueError(f"{args.operator} does not apply to this query")
    parses = F.lit(parse_sql(spark, said["source"])[0])
    seen = _values(spark, made, stage=P.failure_stage(parses, P.corrupted(p, args.operator, family), [found]))["stage"]
    return ["-- source_sql", said["source"], "-- target_sql", said["target"], "-- intended_failure_stage", P.CORRUPTIONS[args.operator][1], "-- observed_failure_stage", seen]


def normalize(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    _, made = _made(args)
    p = F.col("program")
    said = _values(spark, made, source=P.noncanonical(p), target=P.render(P.canonical(p)))
    return ["-- source_sql", said["source"], "-- target_sql", said["target"], "-- normalization_rules", *P.RULES]


def stage(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    export.stage_dataset_repo(args.release_dir, args.output_dir, args.readme)
    return [args.output_dir]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomsql", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(run, **options) -> argparse.ArgumentParser:
        made = commands.add_parser(run.__name__, **options)
        made.set_defaults(run=run)
        return made

    one = command(release, help="build a corpus and its manifest")
    one.add_argument("config_path", nargs="?", help="YAML corpus config; without it the release configuration")
    one.add_argument("--output-dir", default="data/release/corpus_v1")
    one = command(schema, help="write a schema family as JSON")
    one.add_argument("schema_config")
    one.add_argument("--output-dir", default="data/raw/schemas")
    for run, complexity, text in ((clean, "easy", "print a query"), (corrupt, "medium", "print a corrupted query"), (normalize, "medium", "print a query before and after canonicalization")):
        one = command(run, help=text)
        one.add_argument("schema_config")
        one.add_argument("--template-id", default="baseline_summary")
        one.add_argument("--complexity", default=complexity, choices=program.COMPLEXITIES)
        one.add_argument("--seed", type=int, default=0)
        if run is corrupt:
            one.add_argument("--operator", default="unknown_column", choices=list(P.CORRUPTIONS))
    one = command(stage, help="copy a release into a dataset repository")
    one.add_argument("--release-dir", default="data/release/corpus_v1")
    one.add_argument("--output-dir", default="data/release/dataset_repo")
    one.add_argument("--readme", help="file to copy as README.md")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("loomsql").getOrCreate()
    for line in args.run(spark, args):
        print(line)


if __name__ == "__main__":
    main()
