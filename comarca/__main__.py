"""Command line of a run: ``spark-submit -m comarca --root RAW --target table --target file --output OUT``."""

from __future__ import annotations

import argparse
import logging
import sys

from comarca.plans.etl import Run
from comarca.schemas import REJECTED_CELLS
from comarca.session import build_session
from comarca.sinks import registry
from comarca.sources.files import missing_path
from comarca.sources.registry import open_data_readers

PHASES = ("all", "extract", "transform", "load")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="comarca", description="Extract, transform and load the open-data sources.")
    parser.add_argument("--root", required=True, help="folder of the raw sources")
    parser.add_argument("--target", "-t", action="append", choices=[*registry.TARGETS, "all"], help="default: table")
    parser.add_argument("--phase", "-p", choices=PHASES, default="all")
    parser.add_argument("--staging", help="folder that hands transformed sources to a later --phase load")
    parser.add_argument("--output", help="folder of the file and object_store targets")
    parser.add_argument("--jdbc-url", help="database of the warehouse target")
    parser.add_argument("--log-level", "-l", choices=["DEBUG", "INFO", "WARNING", "ERROR"], default="INFO")
    parser.add_argument("--log-file", "-f")
    arguments = parser.parse_args(argv)
    targets = registry.expand_targets(arguments.target)
    if {"file", "object_store"} & set(targets) and not arguments.output:
        parser.error("the file and object_store targets need --output")
    if "warehouse" in targets and not arguments.jdbc_url:
        parser.error("the warehouse target needs --jdbc-url")
    if arguments.phase == "load" and not arguments.staging:
        parser.error("the load phase needs the --staging folder of a transform phase")
    return arguments


def _loaders(arguments: argparse.Namespace) -> dict[str, registry.Loader]:
    return {
        # Reports of one year then read that year's folder only.
        "table": registry.table_loader(partition_by={"fact_poblacion": ["periodo"]}),
        "file": registry.file_loader(arguments.output),
        "object_store": registry.object_loader(arguments.output),
        "warehouse": registry.warehouse_loader(arguments.jdbc_url),
    }


def main(argv: list[str] | None = None) -> int:
    arguments = _arguments(argv)
    logging.basicConfig(level=arguments.log_level, filename=arguments.log_file)
    spark = build_session()
    if arguments.phase != "load" and arguments.staging and not missing_path(spark, arguments.staging):
        logging.getLogger("comarca").error("%s holds an earlier run", arguments.staging)
        return 1
    targets = arguments.target or ["table"]
    run = Run(spark, open_data_readers(arguments.root, rejected=REJECTED_CELLS), _loaders(arguments), targets, staging=arguments.staging)
    if arguments.phase == "load":
        success = run.load_staged()
    elif arguments.phase == "all":
        success = run.run()
    else:
        data = run.extract()
        if arguments.phase == "transform":
            run.transform(data)
        success = not run.errors
    lost = run.rejected_cells().groupBy("source", "column").count().collect() if arguments.phase != "load" else []
    for row in sorted(lost):
        logging.getLogger("comarca").warning("%s cells of %s in %s did not parse", row["count"], row.column, row.source)
    for row in run.metrics().collect():
        logging.getLogger("comarca").info("%s", row.asDict())
    return 0 if success else 1


if __name__ == "__main__":
    sys.exit(main())
