"""Physical-plan summary of every registered query: ``python tests/plan_report.py [sf_dir [name ...]] > PLANS.md``.

Counts, per query, the shuffle exchanges, broadcast exchanges, sort-merge joins and Python
evaluation nodes of the executed plan (after adaptive execution has finalised it), and the
columns each file scan reads and the filters pushed into it.  Model fits and staging run while the
query is built; the counts are for the returned DataFrame's own plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(df) -> dict:
    df.write.format("noop").mode("overwrite").save()          # finalise the adaptive plan
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = text.split("\n\n\n")[0]
    scans = re.findall(r"\) Scan (\w+)[^\n]*\n(?:[^\n]+\n)*?ReadSchema: (struct<[^\n]*>)", text)
    return {
        "shuffles": len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(\d+\)", tree)),
        "smj": len(re.findall(r"SortMergeJoin", tree)),
        "python": len(re.findall(r"(?:ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|"
                                 r"EvalPythonUDTF)\w* \(\d+\)", tree)),
        "single_partition": "SinglePartition" in text,
        "scans": [(fmt, schema if len(schema) < 110 else schema[:107] + "...") for fmt, schema in scans],
        "pushed": sorted(set(x for x in re.findall(r"PushedFilters: (\[[^\n]*\])", text) if x != "[]")),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from scorewright.session import local_session

    spark = local_session()
    qs, oracle = entry.queries(), entry.oracle_sql()
    print(f"# Plan summary ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `tests/plan_report.py`.  shuffles = exchanges (hash/range/round-robin/single) in the")
    print("final adaptive plan; broadcasts = broadcast exchanges; python = Arrow/pandas evaluation nodes;")
    print("check = O (DuckDB oracle) or R (rows only).")
    print("\"single partition\" marks an Exchange SinglePartition: in these plans it only ever carries the")
    print("final merge of a global aggregate (one partial row per task) or a per-slice / per-class table")
    print("(one row per slice or class), never the data itself.\n")
    print("| query | check | shuffles | broadcasts | SMJ | python | single partition |")
    print("|---|---|---|---|---|---|---|")
    details = []
    for name in argv[1:] or sorted(qs):
        try:
            s = summarise(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} | | | | | |")
            continue
        print(f"| {name} | {'O' if name in oracle else 'R'} | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | "
              f"{s['python']} | {'yes' if s['single_partition'] else ''} |")
        details.append((name, s))
    print("\n## Scans (format, columns read, pushed filters)\n")
    for name, s in details:
        scans = "; ".join(f"{f} {sch}" for f, sch in s["scans"]) or "—"
        pushed = " ".join(s["pushed"])
        print(f"- **{name}**: {scans}{'  pushed ' + pushed if pushed else ''}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
