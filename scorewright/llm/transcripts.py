"""Chat formatting: turns and speakers of a raw transcript by a hidden Markov model over its lines, then canonical turns.

A transcript is a sequence of lines.  Each line shows a speaker marker (or none) and line features (length, how it
ends); the hidden state is its speaker's role and whether a turn begins with it.  ``fit`` counts roles, successions and
features over the lines of labelled turns.  ``recover`` finds the most probable states of each whole transcript
(Viterbi) and joins lines into turns; ``render`` strips the markers and writes ``<|role|>`` turns.  A transcript's
text may come whole or in parts (pages of a log); where it is cut into parts says nothing about turns.

Viterbi is a product of matrices over (max, +), and scores are integers, so a transcript can be cut: all
lines are range-sorted by transcript and place and numbered, and each ``CHUNK`` numbers give one small matrix; of
transcripts with several chunks, nodes of up to ``FAN`` neighbours are multiplied, level by level; going down again
fixes the states at every border; then each chunk is decoded alone between its borders.  No group holds more than
``CHUNK`` lines or ``FAN`` matrices, however long a transcript is and however often it repeats a part number.  What a
line shows travels as one small number.

Cases: parts go by number, null ones first, equal ones by text and then as read.  A part with a null transcript id
is a transcript of its own.  A null text counts as empty; an empty text is one empty line.  Ties go to the state
first in ``STATES``.  Repeated rows stay, as lines of their own.  A very long text is split in one task; its lines are
then dealt like any others, and a turn is put together in one task.  An empty table gives an empty result; without
labelled turns all counts are equal.  Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.operators.rank import prefix_before_slice

from .common import prepare, scratch, staged

ROLES = ("user", "assistant", "system")
#: Role and whether a turn begins: state 2 r begins one of role r, 2 r + 1 goes on with it.
STATES = tuple((r, begins) for r in ROLES for begins in (True, False))
START = len(STATES)
CHUNK = 256
FAN = 64
#: Speaker names per role that a marker may hold; a marker with any other name is "other".
NAMES = {"user": ("user", "human", "customer", "q", "question", "me"),
         "assistant": ("assistant", "ai", "bot", "agent", "a", "answer"),
         "system": ("system", "instructions", "context")}
MARKER = r"^\s{0,8}(?:\[([A-Za-z]{1,20})\]|<([A-Za-z]{1,20})>|\**([A-Za-z]{1,20})\**\s?:)\s*"
#: Values of each feature: marker (none, the roles, other), length, last character.
VALUES = (len(ROLES) + 2, 14, 3)
#: How much of each feature's scores all states share.
SHARED = (0.001, 0.2, 0.2)
SCALE = 1024
NEVER = -(1 << 30)


@dataclass(frozen=True)
class Hmm:
    """Integer log2 scores: ``step[from][to]`` (the last row starts a transcript), ``emit[feature][value][state]``."""

    step: list
    emit: list

    def lines(self) -> np.ndarray:
        """Score of each state for every number that a line can show."""
        grid = np.indices(VALUES).reshape(len(VALUES), -1)
        return sum(np.array(e, np.int64)[v] for e, v in zip(self.emit, grid))


def features(text: Column) -> list[Column]:
    name = F.lower(F.concat(*[F.regexp_extract(text, MARKER, g) for g in (1, 2, 3)]))
    marker = F.when(name == "", 0)
    for i, r in enumerate(ROLES):
        marker = marker.when(name.isin(*NAMES[r]), i + 1)
    size = F.floor(F.log2(F.length(text) + 1)).cast("int")
    end = F.regexp_extract(text, r"(\S)\s*$", 1)
    return [marker.otherwise(len(ROLES) + 1), F.least(size, F.lit(VALUES[1] - 1)), F.when(end == "?", 0).when(end == ".", 1).otherwise(2)]


def shown(text: Column) -> Column:
    """The number of what a line shows: its features, the last one counting fastest."""
    code = F.lit(0)
    for v, n in zip(features(text), VALUES):
        code = code * n + v
    return code.cast("int")


def _score(count: float, total: float, kinds: int) -> int:
    return round(SCALE * math.log2((count + 0.5) / (total + 0.5 * kinds)))


def fit(turns: DataFrame, *, key_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role") -> Hmm:
    """Counts over all turns with a known role; what comes back to the driver is a few hundred rows."""
    known = turns.filter(F.col(role_col).isin(*ROLES)).select(
        F.col(key_col).alias("key"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"))
    each = known.select("role", F.posexplode("lines").alias("n", "line")).select("role", (F.col("n") == 0).alias("begins"), shown(F.col("line")).alias("v"))
    seen = np.zeros((START, math.prod(VALUES)))
    for r in each.groupBy("role", "begins", "v").count().collect():
        seen[STATES.index((r["role"], r["begins"])), r["v"]] = r["count"]
    # inside a turn: its first line, and the others, are followed by one that goes on
    size = F.size("lines")
    inside = {r["role"]: r for r in known.groupBy("role").agg(F.sum((size > 1).cast("int")).alias("first"), F.sum(F.greatest(size - 2, F.lit(0))).alias("later")).collect()}
    # a turn's successor has the next number: an equi-join on (transcript, turn) copes with any length
    one = known.filter("key is not null and turn is not null").groupBy("key", "turn").agg(F.min(F.struct("role", (size > 1).alias("long"))).alias("x")).select("key", "turn", "x.*")
    before = one.select("key", (F.col("turn") + 1).alias("turn"), F.col("role").alias("last"), F.col("long").alias("after"))
    moves = np.zeros((START + 1, START))
    for r in one.join(before, ["key", "turn"], "left").groupBy("last", "after", "role").count().collect():
        moves[START if r["last"] is None else STATES.index((r["last"], not r["after"])), STATES.index((r["role"], True))] += r["count"]
    allowed = np.zeros((START + 1, START), bool)
    allowed[:, ::2] = True
    for i, (role, begins) in enumerate(STATES):
        goes_on = STATES.index((role, False))
        allowed[i, goes_on] = True                                   # only the turn's own role goes on, and no transcript begins so
        if role in inside:
            moves[i, goes_on] = inside[role]["first" if begins else "later"]
    step = [[_score(c, row[ok].sum(), int(ok.sum())) if may else NEVER for c, may in zip(row, ok)] for row, ok in zip(moves, allowed)]
    by = seen.reshape(START, *VALUES)
    emit = []
    for f, n in enumerate(VALUES):
        counts = by.sum(axis=tuple(a + 1 for a in range(len(VALUES)) if a != f))
        # a share of what all lines show together, the same for every state: a rare role gains nothing from what it never showed
        share, together = SHARED[f], (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * n)
        own = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
        own[counts.sum(axis=1) == 0] = together
        emit.append([[round(SCALE * math.log2((1 - share) * own[i, v] + share * together[v])) for i in range(START)] for v in range(n)])
    return Hmm(step, emit)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(max, +) product of transfer matrices: rows are the state before (or the start), columns the last state."""
    return (a[:, :, None] + b[None, :START, :]).max(axis=1)


def transfer(emits: np.ndarray, step: np.ndarray) -> np.ndarray:
    m = step + emits[0]
    for e in emits[1:]:
        m = (m[:, :, None] + step[None, :START, :]).max(axis=1) + e
    return m


def borders(matrices: list[np.ndarray], first: int, last: int | None) -> list[int]:
    """The last state of each of a row of nodes, best from state ``first`` (to state ``last``)."""
    scores, back = matrices[0][first], []
    for m in matrices[1:]:
        options = scores[:, None] + m[:START]
        back.append(options.argmax(axis=0))
        scores = options.max(axis=0)
    at = int(scores.argmax()) if last is None else last
    out = [at]
    for b in reversed(back):
        at = int(b[at])
        out.append(at)
    return out[::-1]


def decode(emits: np.ndarray, step: np.ndarray, first: int, last: int | None) -> list[int]:
    return borders([step + e for e in emits], first, last)


def _matrix(flat) -> np.ndarray:
    return np.asarray(flat, np.int64).reshape(START + 1, START)


def _multiply(rows: pd.DataFrame) -> pd.DataFrame:
    rows, m = rows.sort_values("node"), None
    for flat in rows["m"]:
        m = _matrix(flat) if m is None else product(m, _matrix(flat))
    return pd.DataFrame({"key": [rows["key"].iloc[0]], "node": [rows["parent"].iloc[0]], "m": [m.ravel()]})


def _fix(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    first, last = int(rows["first"].iloc[0]), rows["last"].iloc[0]
    ends = borders([_matrix(m) for m in rows["m"]], first, None if pd.isna(last) else int(last))
    return pd.DataFrame({"key": rows["key"], "node": rows["node"], "first": [first, *ends[:-1]], "last": ends})


def _parents(level: DataFrame, top: bool) -> DataFrame:
    return level.withColumn("parent", F.lit(0).cast("long") if top else F.floor(F.col("node") / FAN).cast("long"))


def _border_roles(chunks: DataFrame) -> DataFrame:
    """(key, node, first, last) for the chunks (key, node, m) of transcripts that have several."""
    many = chunks.groupBy("key").count().filter("count > 1").select("key")
    levels = [staged(chunks.join(staged(many, "long"), "key", "left_semi"), "level")]
    while True:
        widest = levels[-1].groupBy("key").count().agg(F.max("count")).first()[0]
        if widest is None or widest <= FAN:
            break
        levels.append(staged(_parents(levels[-1], False).groupBy("key", "parent").applyInPandas(_multiply, "key string, node long, m array<long>"), "level"))
    fixed = None
    for level in reversed(levels):
        nodes = _parents(level, fixed is None)
        if fixed is None:
            nodes = nodes.withColumns({"first": F.lit(START), "last": F.lit(None).cast("int")})
        else:
            nodes = nodes.join(fixed.withColumnRenamed("node", "parent"), ["key", "parent"])
        fixed = staged(nodes.groupBy("key", "parent").applyInPandas(_fix, "key string, node long, first int, last int"), "borders")
    return fixed


def _decoded(parts: DataFrame, model: Hmm, key_col: str, part_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The lines (row, pos, id, text), and without their texts (row, pos, key, line, slice, state); both staged."""
    prepare(parts.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.when(F.col(key_col).isNull(), F.concat(F.lit("row "), F.monotonically_increasing_id())).otherwise(F.concat(F.lit("id "), F.col(key_col).cast("string")))
    read = parts.select(F.col(key_col).alias("id"), F.coalesce(F.col(part_col).cast("long"), F.lit(-(1 << 40))).alias("at"), F.xxhash64(text).alias("tie"),
                        key.alias("key"), F.monotonically_increasing_id().alias("row"), F.posexplode(F.split(text, "\n")).alias("pos", "text"))
    rows = staged(read.withColumn("v", shown(F.col("text"))), "lines")
    with scratch(parts.sparkSession) as keep:
        return rows.select("row", "pos", "id", "text"), keep(staged(_states(rows, model), "states"))


def _states(rows: DataFrame, model: Hmm) -> DataFrame:
    """(key, line, row, pos, slice, state) of the lines (key, at, tie, row, pos, v)."""
    order = ["key", "at", "tie", "row", "pos"]
    # a partition's ids are consecutive from (its number) * 2^33; the totals of the slices are one row per range
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    slices = staged(rows.select(*order, "v").repartitionByRange(*order).sortWithinPartitions(*order)
                    .select("key", "row", "pos", "v", F.spark_partition_id().alias("slice"), place.alias("place"), F.lit(1).alias("one")), "slices")
    number = F.col("before") + F.col("place")
    seen = slices.join(F.broadcast(prefix_before_slice(slices, "one", slice_col="slice", out="before")), "slice").select(
        "key", F.floor(number / CHUNK).cast("long").alias("node"), F.struct(number.alias("line"), "row", "pos", "slice", "v").alias("b"))
    step, scores = np.array(model.step, np.int64), model.lines()

    @F.pandas_udf("array<long>")
    def matrices(codes: pd.Series) -> pd.Series:
        return pd.Series([transfer(scores[np.asarray(v)], step).ravel() for v in codes])

    @F.pandas_udf("array<int>")
    def paths(codes: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([decode(scores[np.asarray(v)], step, int(f), None if pd.isna(t) else int(t)) for v, f, t in zip(codes, first, last)])

    chunks = staged(seen.groupBy("key", "node").agg(F.array_sort(F.collect_list("b")).alias("b")), "chunks")
    codes = F.transform("b", lambda x: x["v"])
    ends = _border_roles(chunks.select("key", "node", matrices(codes).alias("m")))
    return (chunks.join(ends, ["key", "node"], "left").select("key", "b", paths(codes, F.coalesce("first", F.lit(START)), "last").alias("p"))
            .select("key", F.explode(F.arrays_zip("b", "p")).alias("x"))
            .select("key", "x.b.line", "x.b.row", "x.b.pos", "x.b.slice", F.col("x.p").alias("state")))


def _role(state: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r, _ in STATES]), state + 1)


def label_lines(parts: DataFrame, model: Hmm, *, key_col: str = "conv_id", part_col: str = "part", text_col: str = "text") -> DataFrame:
    """One row per line: id, line (its number over all lines of all transcripts, in their order), text, role, begins."""
    rows, told = _decoded(parts, model, key_col, part_col, text_col)
    return rows.join(told, ["row", "pos"]).select(F.col("id").alias(key_col), "line", F.col("text").alias(text_col),
                                                  _role(F.col("state")).alias("role"), (F.col("state") % 2 == 0).alias("begins"))


def recover(parts: DataFrame, model: Hmm, *, key_col: str = "conv_id", part_col: str = "part", text_col: str = "text") -> DataFrame:
    """One row per turn: id, turn (from 0 in its transcript), role, text (its raw lines).

    Turns are numbered before the texts come in, so these move twice: to their states, and to their turn."""
    rows, told = _decoded(parts, model, key_col, part_col, text_col)
    # a turn's number is the count of beginnings up to it, over all lines: slice totals, then a sum inside each slice
    one = (F.col("state") % 2 == 0).cast("int")
    before = F.broadcast(prefix_before_slice(told.select("slice", one.alias("one")), "one", slice_col="slice", out="before"))
    upto = Window.partitionBy("slice").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    numbered = staged(told.withColumn("in_slice", F.sum(one).over(upto)).join(before, "slice").select(
        "row", "pos", "key", "line", "state", (F.col("before") + F.col("in_slice")).alias("n")), "numbered")
    first = numbered.groupBy("key").agg(F.min("n").alias("first"))
    placed = numbered.join(first, "key").select("row", "pos", "line", "state", "n", (F.col("n") - F.col("first")).cast("int").alias("turn"))
    lines = F.array_sort(F.collect_list(F.struct("line", F.col("text").alias("t"))))
    return rows.join(placed, ["row", "pos"]).groupBy("n").agg(
        F.first("id").alias("id"), F.first("turn").alias("turn"), F.first("state").alias("state"), F.array_join(F.transform(lines, lambda x: x["t"]), "\n").alias("t")).select(
        F.col("id").alias(key_col), "turn", _role(F.col("state")).alias("role"), F.col("t").alias(text_col))


def render(text: Column, role: Column) -> Column:
    """The canonical turn: role header, then the text without its marker and outer white space."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), MARKER, ""), r"^\s+|\s+$", "")
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), bare)
