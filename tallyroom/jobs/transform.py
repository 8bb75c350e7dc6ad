"""Clean delimited files, keep the best row per key and write all stages."""

from __future__ import annotations

import argparse

from tallyroom.contracts import PLAYERS
from tallyroom.plans.stages import MALFORMED, build_audited_stages
from tallyroom.session import get_session, input_bytes, run_job, sized_tasks
from tallyroom.sources.delimited import read_with_records


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyroom-transform", description=__doc__)
    parser.add_argument("--input", required=True, help="delimited file, folder or glob")
    parser.add_argument("--output", required=True, help="root folder of the stages")
    parser.add_argument("--multi-line", action="store_true",
                        help="quoted values may hold line breaks; each file is one task")
    parser.add_argument("--replace", action="store_true",
                        help="overwrite stages under the root; none of them may be served")
    args = parser.parse_args(argv)
    spark = get_session("tallyroom-transform")
    with sized_tasks(spark, input_bytes(spark, args.input)):
        records = read_with_records(spark, args.input, args.multi_line)
        counts = build_audited_stages(records, PLAYERS, args.output, args.replace)
        malformed = counts.pop("malformed")
        for stage, rows in counts.items():
            print(f"{stage}: {rows} rows")
        print(f"malformed: {malformed} rows, kept whole in {args.output}/{MALFORMED}")


if __name__ == "__main__":
    run_job(main)
