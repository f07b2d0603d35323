"""Command line: ``python -m foldline <command> ...`` (or through spark-submit).

Every command builds (or joins) a Spark session and runs the library's jobs;
the master comes from the environment (spark-submit, ``--master``).
"""

from __future__ import annotations

import argparse
import sys

from .operators import box_stats, histogram, scatter_points
from .plans import flow, land_source, print_file, print_rows
from .session import build_session
from .sources.catalog import attach_table, show_table
from .streaming.refresh import listen


def _names(text: str | None) -> list[str] | None:
    return [n.strip() for n in text.split(",")] if text else None


def _pipeline_args(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("input_path", help="CSV/JSON source read by the transform")
    parser.add_argument("source", help="name (or URL) the output file is named after")
    parser.add_argument("output_dir")
    parser.add_argument("--database", help="with --table: also store a table")
    parser.add_argument("--table")
    parser.add_argument("--warehouse", help="folder holding <db>.db/<table>")
    parser.add_argument("--format", choices=("csv", "json"))
    parser.add_argument("--names", help="comma-separated positional column names")
    parser.add_argument("--filter-column")
    parser.add_argument("--filter-value")
    parser.add_argument("--single-file", action="store_true", help="publish one file instead of a folder of parts")


def _table_args(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("database")
    parser.add_argument("table")
    parser.add_argument("--warehouse", required=True)


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="foldline", description=__doc__)
    parser.add_argument("--master", help="Spark master (default: from the environment)")
    sub = parser.add_subparsers(dest="command", required=True)

    p = sub.add_parser("land", help="copy a source into the input folder")
    p.add_argument("source")
    p.add_argument("input_dir")
    p.add_argument("--names")
    p.add_argument("--format", choices=("csv", "json"))

    p = sub.add_parser("flow", help="transform, store as table, publish file, preview")
    _pipeline_args(p)
    p.add_argument("--preview", type=int, default=20)

    p = sub.add_parser("listen", help="rerun the flow whenever the input content changes")
    _pipeline_args(p)
    p.add_argument("--state", required=True, help="folder of the listener's state table")
    p.add_argument("--poll-interval", type=float, default=2.0)
    p.add_argument("--max-rounds", type=int)

    p = sub.add_parser("print", help="print a published CSV/JSON dataset")
    p.add_argument("path")
    p.add_argument("--rows", type=int, default=20)

    p = sub.add_parser("show-table", help="databases, tables, schema and a preview")
    _table_args(p)
    p.add_argument("--limit", type=int, default=20)

    p = sub.add_parser("histogram", help="bin counts of a table column")
    _table_args(p)
    p.add_argument("column")
    p.add_argument("--bins", type=int, default=10)

    p = sub.add_parser("boxplot", help="quartiles and whiskers of a table column")
    _table_args(p)
    p.add_argument("value")
    p.add_argument("--category")

    p = sub.add_parser("scatter", help="(x, y) points of two table columns")
    _table_args(p)
    p.add_argument("x")
    p.add_argument("y")
    p.add_argument("--key")
    p.add_argument("--max-rows", type=int, help="sample size (default: all pairs)")
    p.add_argument("--rows", type=int, default=20, help="points to print")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = build_session(args.master)
    try:
        if args.command == "land":
            print(land_source(spark, args.source, args.input_dir, _names(args.names), args.format))
        elif args.command in ("flow", "listen"):
            options = dict(
                warehouse_dir=args.warehouse,
                file_format=args.format,
                column_names=_names(args.names),
                filter_column=args.filter_column,
                filter_value=args.filter_value,
                single_file=args.single_file,
            )
            if args.command == "flow":
                result = flow(
                    spark, args.input_path, args.source, args.output_dir, args.database, args.table,
                    preview_rows=args.preview, **options,
                )
                print(f"table: {result.table_location}\nfile: {result.file_path}")
            else:
                listener = listen(
                    spark, args.input_path, args.source, args.output_dir, args.state,
                    database=args.database, table=args.table, poll_interval=args.poll_interval, **options,
                )
                try:
                    status = listener.run(max_rounds=args.max_rounds)
                except KeyboardInterrupt:
                    status = listener.status
                print(f"rounds: {status.rounds}, refreshes: {status.refreshes}")
        elif args.command == "print":
            print_file(spark, args.path, args.rows)
        elif args.command == "show-table":
            attach_table(spark, args.database, args.table, args.warehouse)
            show_table(spark, args.database, args.table, args.limit)
        else:
            data = attach_table(spark, args.database, args.table, args.warehouse)
            if args.command == "histogram":
                result = histogram(data, args.column, bins=args.bins).orderBy("bin")
                print_rows(result, 100)
            elif args.command == "boxplot":
                result = box_stats(data, args.value, args.category).orderBy("category")
                print_rows(result, 20)
            else:
                result = scatter_points(data, args.x, args.y, key=args.key, max_rows=args.max_rows)
                print_rows(result, args.rows)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
