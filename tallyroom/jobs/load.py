"""Check the staged tables and publish them, all or none."""

from __future__ import annotations

import argparse
import importlib
import os

from tallyroom.contracts import PLAYERS
from tallyroom.plans.publish import publish
from tallyroom.session import get_session, input_bytes, run_job, sized_tasks
from tallyroom.sinks.jdbc import JdbcSink, in_one_transaction
from tallyroom.sinks.tables import TableSink
from tallyroom.sinks.versions import VersionedSink


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyroom-load", description=__doc__)
    parser.add_argument("--input", required=True, help="root folder of the stages")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--tables-root", help="folder for copies of the data, as Spark tables")
    target.add_argument("--in-place", action="store_true",
                        help="Spark tables over the staged folders themselves")
    target.add_argument("--jdbc-url", help="database; user and password come from the "
                        "environment variables JDBC_USER and JDBC_PASSWORD")
    parser.add_argument("--database", default="default", help="database of the Spark tables")
    parser.add_argument("--journal", help="folder of the journal of Spark tables served as views over "
                        "versions, which switch without a gap and recover after a dead driver")
    parser.add_argument("--jdbc-driver", help="driver class")
    parser.add_argument("--client", help="Python database module, such as psycopg2, to create "
                        "the tables with their keys and swap them in at the end; its connection "
                        "string comes from the environment variable DATABASE_DSN")
    parser.add_argument("--jars", help="connector jar, unless spark-submit names it")
    parser.add_argument("--connections", type=int, default=16,
                        help="most database connections open at a time")
    parser.add_argument("--on-missing", choices=["fail", "skip"], default="fail")
    args = parser.parse_args(argv)
    if args.journal and args.jdbc_url:
        parser.error("--journal is for Spark tables")
    spark = get_session("tallyroom-load", jars=args.jars)
    with sized_tasks(spark, input_bytes(spark, args.input)):
        if args.journal and (args.tables_root or args.in_place):
            sink = VersionedSink(spark, args.journal, args.tables_root, args.database)
        elif args.tables_root or args.in_place:
            sink = TableSink(spark, args.tables_root, args.database)
        else:
            properties = {"user": os.environ["JDBC_USER"], "password": os.environ["JDBC_PASSWORD"]}
            if args.jdbc_driver:
                properties["driver"] = args.jdbc_driver
            run_statements = None
            if args.client:
                client = importlib.import_module(args.client)
                run_statements = in_one_transaction(lambda: client.connect(os.environ["DATABASE_DSN"]))
            sink = JdbcSink(args.jdbc_url, properties, run_statements,
                            num_partitions=args.connections)
        for name in publish(spark, PLAYERS, args.input, sink, args.on_missing):
            print(f"published {name}")


if __name__ == "__main__":
    run_job(main)
