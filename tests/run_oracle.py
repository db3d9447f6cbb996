"""Run every catalogue query against its DuckDB oracle and print one JSON line per query.

    python tests/run_oracle.py [SF_DIR] [KEY_PREFIX,...] [--plain]

``--plain`` uses a default SparkSession instead of ``cauce.build_session`` (as a caller
that did not build the session would). Exit status 1 when any query disagrees.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)


def main(argv: list[str]) -> int:
    plain = "--plain" in argv
    args = [a for a in argv if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    prefixes = args[1].split(",") if len(args) > 1 else []

    from oracle import compare, duck
    from pyspark.sql import SparkSession

    from cauce.plans.catalog import ORACLE, QUERIES
    from cauce.session import build_session

    spark = SparkSession.builder.master("local[8]").getOrCreate() if plain else build_session("local[8]")
    con = duck(sf_dir)
    bad = []
    for key, fn in QUERIES.items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            result = compare(df, con, ORACLE[key]) if key in ORACLE else {"rows_spark": df.count(), "ok": None}
        except Exception as exc:  # report and continue with the next query
            result = {"ok": False, "error": repr(exc)[:500]}
        result["sec"] = round(time.time() - t0, 2)
        if result.get("ok") is False:
            bad.append(key)
        print(json.dumps({"query": key, **result}, default=str), flush=True)
    print(json.dumps({"failed": bad}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
