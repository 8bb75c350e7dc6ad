"""Write every dashboard view of a published table to a folder."""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from tallyroom.plans.dashboard import Dashboard
from tallyroom.session import get_session, input_bytes, run_job, run_together, sized_tasks
from tallyroom.sources.parquet import read_parquet


def _write(view: DataFrame, path: str) -> None:
    view.write.mode("overwrite").parquet(path)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyroom-dashboard", description=__doc__)
    parser.add_argument("--input", required=True, help="folder of the master table")
    parser.add_argument("--output", required=True, help="folder for the views, one each")
    parser.add_argument("--rating", nargs=2, type=int, metavar=("LOW", "HIGH"))
    parser.add_argument("--region")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--keep", choices=["memory", "none"], default="memory",
                        help="none: every view scans the columns it needs")
    parser.add_argument("--countries", help="Parquet folder of the region dimension")
    parser.add_argument("--rows", action="store_true", help="also copy all filtered rows")
    args = parser.parse_args(argv)
    spark = get_session("tallyroom-dashboard")
    with sized_tasks(spark, input_bytes(spark, args.input)):
        keep = StorageLevel.MEMORY_AND_DISK if args.keep == "memory" else None
        countries = read_parquet(spark, args.countries) if args.countries else None
        board = Dashboard(read_parquet(spark, args.input), countries=countries, keep=keep)
        try:
            views = board.views(tuple(args.rating) if args.rating else None, args.region, args.seed)
            views = board.inputs() | views
            if not args.rows:
                del views["rows"]
            if keep is not None:
                # Filled once: views that start together would each compute the same partitions.
                board.rows.count()
            run_together(spark, [partial(_write, view, f"{args.output.rstrip('/')}/{name}")
                                 for name, view in views.items()])
            print(f"wrote {', '.join(views)}")
        finally:
            board.close()


if __name__ == "__main__":
    run_job(main)
