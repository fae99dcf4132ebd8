"""Run every registered query against its oracle: ``python tests/check_oracle.py [prefix...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402

from loam.session import get_spark  # noqa: E402
from loam.suite import ORACLE, QUERIES  # noqa: E402


def main(argv):
    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]", shuffle_partitions=8, extra_conf={"spark.driver.memory": "8g"})
    con = duck(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        t = time.time()
        try:
            if name in ORACLE:
                ok, msg = compare(spark, name, fn, ORACLE[name], sf, con)
            else:
                n = fn(spark, sf).count()
                ok, msg = True, f"rows-only: {n} rows"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:45s} {time.time() - t:6.2f}s  {msg}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
