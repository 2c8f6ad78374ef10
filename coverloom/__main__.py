"""python -m coverloom SUB-COMMAND ..."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from coverloom.cli import config
from coverloom.cli.arguments import ArgumentError, Given, parser
from coverloom.cli.run import run, with_config


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("coverloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if a.config:
            a = with_config(a, vars(parser(Given).parse_args(argv)), config.parse(config.read(spark, a.config)))
        run(spark, a)
    except ArgumentError as e:
        print(f"coverloom: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
