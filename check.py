"""Run registered queries against their DuckDB statements: check.py [folder] [name ...]"""

from __future__ import annotations

import sys
import tempfile
import time

from mercatura.session import build_session
from oracles.compare import connect, difference
from oracles.registry import REGISTRY


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        "check",
        spark_master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_checkpoint_dir=tempfile.mkdtemp(prefix="mercatura-check-", dir="/tmp"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        entry = REGISTRY[name]
        started = time.time()
        try:
            df = entry.run(spark, folder)
            if entry.sql is None:
                verdict = f"rows only: {df.count()}"
            else:
                found = difference(df, con, entry.sql)
                verdict = "ok" if found is None else f"DIFFERS {found}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        failed += verdict.startswith(("DIFFERS", "ERROR"))
        print(f"{time.time() - started:6.2f}s {name}: {verdict}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
