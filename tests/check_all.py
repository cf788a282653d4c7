"""Compare every query with its oracle: python tests/check_all.py [sf] [key prefix ...]"""

import sys
import time
import traceback

sys.path[:0] = [".", "tests"]
from oracle import compare, oracle_connection  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from zonetide.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
want = sys.argv[2:]
spark = build_session(
    "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
)
spark.sparkContext.setLogLevel("ERROR")
con = oracle_connection(sf)
oracles = entry.oracle_sql()
bad = 0
for key, run in entry.queries().items():
    if want and not any(key.startswith(w) for w in want):
        continue
    t = time.time()
    try:
        found = compare(spark, con, run, oracles[key], sf) if key in oracles else f"rows: {run(spark, sf).count()}"
    except Exception as e:  # noqa: BLE001
        found = f"{type(e).__name__}: {str(e).strip().splitlines()[0][:300] if str(e) else ''}"
        if want:
            traceback.print_exc()
    if found:
        bad += 1
    print(f"{'BAD ' if found else 'ok  '} {time.time() - t:6.2f}s {key} {found or ''}", flush=True)
print(f"{bad} bad of {len(entry.queries())}")
