"""Run every registered query against its oracle: python tests/run_all.py SF [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from harness import compare, connect  # noqa: E402
from palimpsest.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            r = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
            ok = r["equal"] and r["columns"] and not r["types"]
            detail = "" if ok else r
        except Exception as e:  # noqa: BLE001
            ok, detail, r = False, f"{type(e).__name__}: {str(e)[:600]}", {"rows": None}
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} rows={r['rows']} {time.time() - start:.1f}s "
              f"{detail}", flush=True)
    print(f"{len(names) - failed}/{len(names)} match")
