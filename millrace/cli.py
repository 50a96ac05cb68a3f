"""Command line: databases, migrations and schema printing."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from millrace import migrations
from millrace.sources.tables import Catalog, quoted


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    top.add_argument("--database", default="default")
    top.add_argument("--migrations", default="migrations")
    top.add_argument("--tracking", default="spark-warehouse/_migrations")
    kinds = top.add_subparsers(dest="kind", required=True)
    db = kinds.add_parser("database").add_subparsers(dest="what", required=True)
    for what in ("create", "drop", "reset"):
        db.add_parser(what)
    mig = kinds.add_parser("migration").add_subparsers(dest="what", required=True)
    mig.add_parser("run").add_argument("--to", type=int)
    back = mig.add_parser("revert")
    back.add_argument("-n", type=int, default=1)
    back.add_argument("--to", type=int)
    mig.add_parser("redo").add_argument("-n", type=int, default=1)
    mig.add_parser("generate").add_argument("name")
    mig.add_parser("list")
    mig.add_parser("pending")
    kinds.add_parser("setup")
    show = kinds.add_parser("print-schema")
    show.add_argument("--only", nargs="*", default=[])
    show.add_argument("--without", nargs="*", default=[])
    return top


def main(argv=None, spark: SparkSession | None = None, out=sys.stdout) -> int:
    a = parser().parse_args(argv)
    if a.kind == "migration" and a.what == "generate":
        print(migrations.generate(a.migrations, a.name), file=out)
        return 0
    spark = spark or SparkSession.builder.appName("millrace").getOrCreate()
    name = quoted(a.database)
    if a.kind == "database":
        if a.what in ("drop", "reset"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        if a.what in ("create", "reset"):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
        if a.what == "reset" and os.path.isdir(a.migrations):
            # the schema comes back from the migrations, all of which count as not run
            spark.sql(f"USE {name}")
            harness = migrations.Harness(spark, migrations.from_folder(a.migrations), a.tracking)
            harness.forget()
            print(*harness.run(), file=out)
        return 0
    if a.kind == "print-schema":
        out.write(Catalog(spark, a.database).print_schema(a.only, a.without))
        return 0
    if a.kind == "setup":
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    harness = migrations.Harness(spark, migrations.from_folder(a.migrations), a.tracking)
    if a.kind == "setup" or a.what == "run":
        print(*harness.run(getattr(a, "to", None)), file=out)
    elif a.what == "revert":
        print(*harness.revert(a.n, a.to), file=out)
    elif a.what == "redo":
        print(*harness.redo(a.n), file=out)
    else:
        done = harness.applied()
        for m in harness.all:
            if a.what == "list" or m.version not in done:
                print("[x]" if m.version in done else "[ ]", m.version, m.name, file=out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
