"""Command line: ``python -m skarn FOLDER COMMAND [NAME ...]`` over a graph's Parquet tables."""

from __future__ import annotations

import argparse

COMMANDS = ("status", "files", "query", "node", "context", "callers", "callees", "call_graph", "hierarchy", "usages", "impact", "ancestors", "children", "path", "affected", "cycles", "dead_code", "metrics")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="skarn")
    parser.add_argument("folder")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("names", nargs="*")
    parser.add_argument("--depth", type=int)
    parser.add_argument("--limit", type=int, default=20)
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from .api import SymbolGraph

    own = SymbolGraph.over(SparkSession.builder.getOrCreate(), args.folder)
    if args.command == "query":
        out = own.search(" ".join(args.names), args.limit)
    else:
        more = {"depth": args.depth} if args.depth is not None and args.command in ("callers", "callees", "call_graph", "impact", "affected") else {}
        out = getattr(own, args.command)(*args.names, **more)
    out.show(args.limit, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
