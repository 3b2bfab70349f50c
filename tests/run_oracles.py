"""Compare every registered query with its oracle: python tests/run_oracles.py [sf_dir] [name…]."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from campaignlake.plans.catalogue import ORACLES, QUERIES  # noqa: E402
from campaignlake.session import build_session  # noqa: E402
from tests.oracle import check, connect  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in wanted:
        start = time.time()
        try:
            if name in ORACLES:
                problem = check(spark, connection, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failures += problem is not None
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:6} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(wanted)} queries, {failures} failures")
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
