"""python tests/run_oracles.py [sf_dir] [name prefix ...]: checks every registered query against its oracle."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402
from promptmill.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, con = local_session(8), connect(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if prefixes and not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            if name in sqls:
                found = compare(spark, con, name, fn, sqls[name], sf)
                note = "ok" if not found else "DIFF"
            else:
                n = len(fn(spark, sf).collect())
                found, note = ([] if n else [f"{name}: no rows"]), f"rows {n}"
        except Exception as e:
            found, note = [f"{name}: {type(e).__name__} {str(e)[:1500]}"], "ERROR"
        bad += bool(found)
        print(f"{note:8} {name} {time.time() - t:.1f}s", flush=True)
        for f in found:
            print("   ", f, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
