"""Command line of the jobs, e.g. ``spark-submit --py-files semprune.zip main.py similarity --help``.

The options of a command are the parameters of its job function.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from semprune.plans import jobs
from semprune.session import ship_package

SUFFIX = "_job"


def _add_option(parser: argparse.ArgumentParser, parameter: inspect.Parameter) -> None:
    name = "--" + parameter.name.replace("_", "-")
    kind = str(parameter.annotation)
    required = parameter.default is inspect.Parameter.empty
    default = None if required else parameter.default
    if kind == "bool":
        parser.add_argument(name, action=argparse.BooleanOptionalAction, default=default)
        return
    scalar = float if "float" in kind else int if "int" in kind else str
    if kind.startswith("list"):
        parser.add_argument(name, type=scalar, nargs="+", required=required, default=default)
    else:
        parse = (lambda text: None if text.lower() == "none" else scalar(text)) if "None" in kind else scalar
        parser.add_argument(name, type=parse, required=required, default=default)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="semprune")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, job in inspect.getmembers(jobs, inspect.isfunction):
        if not name.endswith(SUFFIX):
            continue
        summary = (inspect.getdoc(job) or name).split("\n")[0]
        command = commands.add_parser(name[: -len(SUFFIX)].replace("_", "-"), help=summary)
        command.set_defaults(job=job)
        for parameter in list(inspect.signature(job).parameters.values())[1:]:
            _add_option(command, parameter)
    return parser


def main(arguments: list[str] | None = None) -> None:
    options = vars(build_parser().parse_args(arguments))
    options.pop("command")
    job = options.pop("job")
    spark = SparkSession.builder.appName(f"semprune {job.__name__}").getOrCreate()
    ship_package(spark)
    job(spark, **options)


if __name__ == "__main__":
    main()
