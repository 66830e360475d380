"""Run registered queries against their SQL: ``python tests/check_all.py [sf_dir] [name ...]``."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from compare import difference  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from feedloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sql = E.oracle_sql()
    bad = 0
    for name, run in E.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            problem = difference(frame, sf_dir, sql[name]) if name in sql else f"no SQL, {frame.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} differ")
