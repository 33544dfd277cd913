"""Commands: run a query of the catalogue over a folder of tables, or list them.

    python -m concordat list
    python -m concordat run NAME FOLDER [--to PATH] [--format parquet|csv|json]
"""

from __future__ import annotations

import argparse


def main(arguments: list[str] | None = None) -> int:
    from .plans.registry import QUERIES

    p = argparse.ArgumentParser("concordat")
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    run = commands.add_parser("run")
    run.add_argument("name", choices=sorted(QUERIES))
    run.add_argument("folder")
    run.add_argument("--to")
    run.add_argument("--format", default="parquet", choices=("parquet", "csv", "json"))
    a = p.parse_args(arguments)
    if a.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    from pyspark.sql import SparkSession

    df = QUERIES[a.name](SparkSession.builder.getOrCreate(), a.folder)
    if a.to:
        df.write.mode("overwrite").option("header", True).format(a.format).save(a.to)
    else:
        df.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
