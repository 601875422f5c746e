"""``python -m trackloom JOB INPUT --out DIR [--json] [--files] [--set name=value ...]`` (or spark-submit).

Results are Parquet tables below DIR; with ``--files`` a job's records are one JSON file each, in their sample's folder.
"""

from __future__ import annotations

import argparse
import json
import os

from trackloom.plans.commands import COMMANDS, WHOLE, Dataset
from trackloom.session import build_session
from trackloom.sources.record_files import write_record_files
from trackloom.sources.versioned import write_tables


def option(text: str) -> tuple[str, object]:
    """``name=value`` with a JSON value, else plain text."""
    name, _, value = text.partition("=")
    try:
        return name, json.loads(value)
    except ValueError:
        return name, value


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="trackloom", description=__doc__)
    parser.add_argument("job", choices=sorted(COMMANDS))
    parser.add_argument("input", help="ingested tables, or the dataset folder with --json")
    parser.add_argument("--out", required=True)
    parser.add_argument("--json", action="store_true", help="read the per-frame JSON files")
    parser.add_argument("--files", action="store_true", help="write records as one file each")
    parser.add_argument("--set", action="append", default=[], type=option, metavar="NAME=VALUE")
    args = parser.parse_args(argv)
    spark = build_session(f"trackloom {args.job}", os.environ.get("TRACKLOOM_CPUS"))
    data = Dataset(spark, args.input, from_json=args.json)
    if args.job in WHOLE:
        write_tables(COMMANDS[args.job](data, **dict(args.set)), args.out)
        return
    for name, table in COMMANDS[args.job](data, **dict(args.set)).items():
        target = f"{args.out.rstrip('/')}/{name}"
        if args.files and table.columns == ["path", "value"]:
            write_record_files(table, target)
        else:
            table.write.mode("errorifexists").parquet(target)


if __name__ == "__main__":
    main()
