"""Command line / spark-submit entry for the batch run.

    python -m cauce [--source all|renta|delitos|contact] [--in DIR] [--out DIR] [--single-file]

Roots default to DATA_IN_DIR / DATA_OUT_DIR / DATA_DIR (see ``cauce.sources.layout``).
On a cluster the master and resources come from spark-submit.
"""

from __future__ import annotations

import argparse

from cauce.plans import etl
from cauce.session import build_session
from cauce.sources.layout import SOURCES, Layout


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(prog="cauce", description="load -> clean -> integrate")
    parser.add_argument("--source", default="all", choices=("all", *SOURCES))
    parser.add_argument("--in", dest="in_root")
    parser.add_argument("--out", dest="out_root")
    parser.add_argument("--single-file", action="store_true", help="one CSV part (small results only)")
    parser.add_argument("--sequential", action="store_true", help="run independent stages one by one")
    args = parser.parse_args(argv)
    spark = build_session()
    layout = Layout.resolve(in_root=args.in_root, out_root=args.out_root)
    out = etl.run_all(spark, layout, source=args.source, parallel=not args.sequential, single_file=args.single_file)
    print(out)
    return out


if __name__ == "__main__":
    main()
