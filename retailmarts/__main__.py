"""Command line: ``spark-submit`` or ``python -m retailmarts <command>``."""

from __future__ import annotations

import argparse

from retailmarts.operators import quality, review_repair
from retailmarts.plans import incremental, load
from retailmarts.session import session
from retailmarts.sources import layers
from retailmarts.sources.schemas import RAW
from retailmarts.sources.tables import Tables
from retailmarts.streaming.ingest import ingest


def written(spark, root: str) -> dict:
    """All layers of a build under ``root``."""
    no_source = Tables({})
    enriched = Tables({
        name: (lambda name=name: layers.read_table(spark, root, "staging", name))
        for name in load.enriched_tables(no_source).makers
    })
    stg = load.staging_models(enriched)
    marts = {name: layers.read_table(spark, root, "mart", name) for name in load.mart_models(stg).makers}
    return {**enriched.pick(enriched.makers), **stg.pick(stg.makers), **marts}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="retailmarts")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, summary: str, *arguments: str) -> None:
        sub = commands.add_parser(name, help=summary)
        for argument in arguments:
            sub.add_argument(argument)

    command("load", "load <landing>/<table>.csv into the raw layer", "landing", "root")
    command("build", "build enriched tables and marts from <landing>/<table>.csv", "landing", "root")
    command("rebuild", "build enriched tables and marts from the ingested files", "root")
    command("refresh", "bring the marts up to date with newly ingested files", "root")
    command("check", "run the declared checks on a build", "root")
    command("validate", "run the validations of the raw layer", "root")
    command("repair-reviews", "repair a review file", "source", "target")
    command("ingest", "append the files that are new in a folder", "table", "folder", "root")
    args = parser.parse_args(argv)

    spark = session()
    if args.command == "load":
        load.load_all(spark, args.root, args.landing).show(truncate=False)
    elif args.command == "build":
        layers.row_counts(load.build(spark, load.landed(spark, args.landing), args.root)).show(truncate=False)
        load.write_rejects(spark, args.landing, args.root).groupBy("table_name").count().show(truncate=False)
    elif args.command == "rebuild":
        layers.row_counts(load.build(spark, load.ingested(spark, args.root), args.root)).show(truncate=False)
    elif args.command == "refresh":
        layers.row_counts(incremental.refresh_ingested(spark, args.root)).show(truncate=False)
    elif args.command == "check":
        checks = quality.report(quality.run_checks(written(spark, args.root)))
        checks.orderBy("status", "table_name", "column_name").show(len(quality.CHECKS), truncate=False)
    elif args.command == "validate":
        tables = Tables({t: (lambda t=t: layers.read_table(spark, args.root, "raw", t)) for t in RAW})
        found = quality.validations(tables, {t: spec.key for t, spec in RAW.items() if spec.key})
        found.orderBy("status", "validation", "subject").show(200, truncate=False)
    elif args.command == "repair-reviews":
        review_repair.repair_file(spark, args.source, args.target).show()
    else:
        target = layers.table_path(args.root, "landed", args.table)
        ingest(spark, args.table, args.folder, target, f"{target}__progress")


if __name__ == "__main__":
    main()
