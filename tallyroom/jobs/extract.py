"""Write the members of zip archives to a folder."""

from __future__ import annotations

import argparse

from tallyroom.errors import ContractError
from tallyroom.session import get_session, input_bytes, run_job, sized_tasks
from tallyroom.sources.archive import UNSAFE, extract_archives, read_manifest


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyroom-extract", description=__doc__)
    parser.add_argument("--input", required=True, help="archive, folder or glob of archives")
    parser.add_argument("--output", required=True, help="folder for the members")
    parser.add_argument("--folder-per-archive", action="store_true")
    parser.add_argument("--skip-unsafe", action="store_true",
                        help="do not fail on members whose names leave the folder")
    args = parser.parse_args(argv)
    spark = get_session("tallyroom-extract")
    with sized_tasks(spark, input_bytes(spark, args.input)) as tasks:
        files = extract_archives(spark, args.input, args.output, args.folder_per_archive, tasks)
        print(f"{files.count()} members written to {args.output}")
        unsafe = read_manifest(spark, args.output).where(f"status = '{UNSAFE}'")
        n_unsafe = unsafe.count()
        # The first hundred names; the manifest lists all.
        for r in unsafe.orderBy("archive", "member").limit(100).collect():
            print(f"not written, unsafe name: {r.member} in {r.archive}")
        if n_unsafe and not args.skip_unsafe:
            raise ContractError(f"{n_unsafe} members with unsafe names were not written")


if __name__ == "__main__":
    run_job(main)
