"""python -m tierflow QUERY INPUT [OUTPUT]: runs a registered query; shows or writes its rows."""

from __future__ import annotations

import argparse
import importlib

from tierflow.common import discard_tables
from tierflow.plans import registry
from tierflow.session import session


def main() -> None:
    known = dict(registry.QUERIES)
    try:  # by name, as the core imports nothing of the subpackage
        known |= importlib.import_module("__spark_entry__").queries()
    except ImportError:
        pass
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("query", choices=sorted(known), metavar="QUERY")
    parser.add_argument("input", help="folder of the Parquet tables")
    parser.add_argument("output", nargs="?", help="folder to write Parquet to; without it 20 rows are shown")
    parser.add_argument("--master", help="e.g. local[8]; on a cluster spark-submit sets it")
    parser.add_argument("--checkpoints", help="folder that all executors share; needed where spark.checkpoint.dir is not set")
    args = parser.parse_args()
    spark = session(args.master, checkpoints=args.checkpoints)
    df = known[args.query](spark, args.input)
    if args.output:
        df.write.mode("overwrite").parquet(args.output)
    else:
        df.show(20, truncate=80)
    discard_tables(spark)


if __name__ == "__main__":
    main()
