"""Compares all or some queries with their SQL: ``check_queries.py SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main(sf_dir: str, *wanted: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            problems = compare(df, con, oracles[name]) if name in oracles else []
            note = "" if name in oracles else f" (no SQL, {df.count()} rows)"
        except Exception as error:
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok'} {name} {time.time() - started:.2f}s{note}", flush=True)
        for problem in problems:
            print("    ", problem[:1800], flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*[a for a in sys.argv[1:] if a != "-v"])))
