"""Line dedup: levelled runs against plain sets, dropped lines against brute force."""

from __future__ import annotations

import random
import uuid
from collections import Counter

import pytest

from llm_edge import edge, no_rows  # noqa: F401
from scorewright.llm import linedup
from scorewright.session import work_path
from scorewright.sinks.fs import list_names

BLANKS = " \t\n\x0b\x0c\r"
LOW = str.maketrans(linedup.UPPER, linedup.LOWER)


def key(line):
    return line.strip(BLANKS).translate(LOW)


def brute(rows, limit, least=1):
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or held[key(x)] < limit]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted(((r[0], r["n_lines"], r["n_dropped"], r["text"]) for r in linedup.drop_lines(df, **kw).collect()), key=str)


@pytest.mark.parametrize("limit", [2, 3, 100])
def test_edge_rows(edge, limit):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert got(edge, limit=limit, batches=3, fanout=2, buckets=4) == brute(rows, limit)


def test_random_lines_in_every_layout(spark):
    rng = random.Random(7)
    pool = [rng.choice(["a", "B", "É", "x y", "", " ", "long line"]) + str(rng.randint(0, 12)) for _ in range(40)] + ["", " \t", "A", "a "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(150)] + [(3, "A\nq\nA")] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts, kw in ((1, {"batches": 1}), (5, {"batches": 5, "fanout": 2, "buckets": 3}), (3, {"batches": 4, "fanout": 9, "min_chars": 2})):
        assert got(df.repartition(parts), limit=10, **kw) == brute(rows, 10, kw.get("min_chars", 1))


def test_empty_table(no_rows):
    assert linedup.drop_lines(no_rows).count() == 0


def hashes(spark, keys):
    return spark.createDataFrame([(k, -k) for k in keys], "h1 long, h2 long")


def test_runs_add_unseen_lines_only(spark):
    """With limit 1 each batch adds exactly the lines no batch before it had."""
    rng, path = random.Random(1), work_path(spark, "llm", f"runs-{uuid.uuid4().hex}")
    runs, seen = linedup.LineRuns(spark, path, limit=1, fanout=2, buckets=3), set()
    for _ in range(5):
        batch = [rng.randint(0, 60) for _ in range(30)]
        own = {r["h1"] for r in runs.add(hashes(spark, batch)).collect()}
        assert own == set(batch) - seen
        seen |= own
    assert {r["h1"] for r in runs.frequent().collect()} == seen
    assert sorted(r[0] for r in runs.live) == [0, 2]          # five batches, compacted by twos
    runs.drop()
    assert list_names(spark, path) == []


def test_runs_reopened_after_an_unfinished_compaction(spark):
    """Sources that a lost writer didn't delete are covered by the compacted run and counted once."""
    path = work_path(spark, "llm", f"runs-{uuid.uuid4().hex}")
    runs = linedup.LineRuns(spark, path, limit=3, fanout=2, buckets=2)
    for batch in ([1, 2], [1, 3], [1, 2, 3]):
        runs.add(hashes(spark, batch))
    runs.add(hashes(spark, [4]))                              # compacts; the replaced runs are still there
    assert len(list_names(spark, path)) > len(runs.live)
    again = linedup.LineRuns(spark, path, limit=3, fanout=2)
    assert again.buckets == 2 and {(r["h1"], r["n"]) for r in again.frequent().collect()} == {(1, 3)}
    again.add(hashes(spark, [2, 3]))
    assert {r["h1"] for r in again.frequent().collect()} == {1, 2, 3}


def test_runs_are_joined_without_moving_them(spark):
    """The batch is shuffled by the hash; the runs' side of each anti-join has no exchange."""
    runs = linedup.LineRuns(spark, work_path(spark, "llm", f"runs-{uuid.uuid4().hex}"), limit=1, fanout=9, buckets=8)
    runs.add(hashes(spark, range(50)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = hashes(spark, range(40, 60)).groupBy("h1", "h2").count().join(spark.table(runs.live[0][3]).select("h1", "h2"), ["h1", "h2"], "left_anti")
        plan = batch._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
