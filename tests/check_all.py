"""Run queries against their SQL: python tests/check_all.py SF_DIR [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import connect, difference  # noqa: E402

from tablestream.plans import QUERIES  # noqa: E402
from tablestream.session import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        q = QUERIES[name]
        began = time.time()
        try:
            problem = difference(q.build(spark, sf_dir), con, q.sql) if q.sql else None
        except Exception as e:  # report every query, then fail
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - began:6.2f}s {'ok' if problem is None else problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
