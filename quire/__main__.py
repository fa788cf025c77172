"""Command line: ``python -m quire queries | run | load | slice``; run it with spark-submit's settings on a cluster."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire.plans import load, registry
from quire.session import build_session
from quire.sources import readers


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="quire", description=__doc__)
    commands = root.add_subparsers(dest="command", required=True)
    commands.add_parser("queries", help="name the queries")
    run = commands.add_parser("run", help="run a query over a folder of tables and write its result as Parquet")
    run.add_argument("query")
    run.add_argument("tables")
    run.add_argument("result")
    put = commands.add_parser("load", help="load observations (Parquet: source, raw_payload, source_updated) into a catalogue")
    put.add_argument("catalogue")
    put.add_argument("observations")
    cut = commands.add_parser("slice", help="write the first lines of a dump as a gzip text of its own")
    cut.add_argument("dump")
    cut.add_argument("lines", type=int)
    cut.add_argument("result")
    return root


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    given = parser().parse_args(argv)
    known = registry.queries()
    if given.command == "queries":
        print("\n".join(sorted(known)))
        return 0
    if given.command == "run" and given.query not in known:
        print(f"no query {given.query}")
        return 2
    session = spark or build_session()
    if given.command == "run":
        known[given.query](session, given.tables).write.mode("errorifexists").parquet(given.result)
    elif given.command == "load":
        now = F.lit(datetime.now(timezone.utc))
        version = load.Catalogue(session, given.catalogue).load(session.read.parquet(given.observations).select("source", "raw_payload", "source_updated"), now)
        print(f"version {version}")
    else:
        readers.slice_dump(session, given.dump, given.lines, given.result)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
