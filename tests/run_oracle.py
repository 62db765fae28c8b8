"""Run registered queries against their DuckDB oracle: ``python tests/run_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_util import compare, duck, spark_pdf  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    import __spark_entry__ as entry
    from scorewright.session import local_session

    spark = local_session()
    qs, oracle = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    failed = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            sp = spark_pdf(df)
            t1 = time.time()
            if name in oracle:
                od = con.execute(oracle[name]).df()
                res = compare(sp, od)
                ok = res["close"]
            else:
                res = {"rows_only": len(sp), "cols": list(sp.columns)}
                ok = True
        except Exception as e:  # report and go on
            res, ok, t1 = {"error": f"{type(e).__name__}: {str(e)[:400]}"}, False, time.time()
        failed += not ok
        print(json.dumps({"query": name, "ok": ok, "sec": round(t1 - t0, 2), **res}, default=str), flush=True)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
