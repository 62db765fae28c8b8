"""Secret scans with an incremental blob ledger, in DataFrame expressions only.

A blob is a text by content (SHA-256).  The ledger holds, per blob and rule version, the findings of
one scan: two Parquet folders, ``scanned`` (blob, rules) and ``findings`` (blob, rules, kind, start, end;
places in code points, end exclusive).  A scan takes the distinct blobs of all the versions handed in, drops those
the ledger already has under this rule version, scans the rest, appends to the ledger, and joins the
findings back to every path that ever held the blob.  A changed rule set has another version, so it
scans again; old findings stay under theirs.  Private keys (``pem``) are found by their lines, see ``key_spans``.

Findings are written before the scanned marks, and duplicates are removed on reading: a run that dies
in between is repeated without harm.  The ledger belongs in a shared folder.

Cases: null text counts as empty (no finding).  Repeated rows and null paths each keep their row.  An
empty table gives an empty result and an empty ledger.  Very long texts are scanned whole, patterns without bounds on
what they match.  Matches of a kind are leftmost and do not
overlap; those of different kinds may.  Only the named columns are read; others don't clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewright.sinks.fs import exists

from .common import let, prepare, staged


@dataclass(frozen=True)
class Rule:
    """A pattern of which ``group`` needs ``least`` characters; matches that fail are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    literal: str | None = None               # every match holds it: cheap first test


#: Lines of a private key.  A marker may stand anywhere in its line; other lines count without what leads and follows
#: them (quotes, comment signs, diff and list marks).
BEGIN = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
END = r"-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
EDGES = r"^[^A-Za-z0-9]+|[^A-Za-z0-9=]+$"
FULL, SHORT = r"^[A-Za-z0-9+/=\\]{16,}$", r"^[A-Za-z0-9+/=\\]+$"
HEADER = r"^[^A-Za-z0-9]*[A-Za-z][A-Za-z0-9-]*: "
CHECKSUM = r"^[^A-Za-z0-9]*=[A-Za-z0-9+/]{4}[^A-Za-z0-9]*$"
#: Body behind a marker in the same line (line breaks written out, or none).
INLINE = r"^(?:\\[rn]|[^A-Za-z0-9])*[A-Za-z0-9+/=\\]{16,}"

#: Fixed kinds, then kinds of our own (a private key; a signed web token).
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", literal="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", BEGIN, literal="PRIVATE KEY"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}", literal="eyJ"),
)
BASE = ("assign", "access", "hex")


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def key_spans(text: Column) -> Column:
    """Places of private keys, by a fold over the lines: no length of key, leader or line is too long.

    A key begins at its BEGIN marker and goes on over header fields and blank lines to base64 lines of 16 characters
    or more, and ends with an END marker, or, where there is none, with its last base64 line: a shorter one, a
    checksum or blank lines may follow before an END.  Any other line ends it before.  A second BEGIN marker inside
    goes on with the same span.  (State 0: no key; 1: begun; 2: in the body; 3: behind a short line.)"""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("state"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("e"),
                     F.array().cast("array<struct<b: bigint, e: bigint>>").alias("out"))
    long, short, none = (lambda c: c.cast("long")), F.lit(3), F.lit(0)

    def state(acc, **new):
        return F.struct(*[new.get(c, acc[c]).alias(c) for c in ("at", "state", "b", "e", "out")])

    def closed(acc, b, e):
        return F.concat(acc["out"], F.array(F.struct(b.alias("b"), e.alias("e"))))

    def step(acc, line):
        n, at = long(F.length(line)), acc["at"]
        following, inside = at + n + 1, acc["state"] > 0
        last = lambda pattern: long(F.length(F.element_at(F.split(line, pattern, -1), -1)))
        # a line with BEGIN: open if the last marker is a BEGIN, else closed behind its last END
        start = F.when(inside, acc["b"]).otherwise(at + long(F.length(F.get(F.split(line, BEGIN, 2), 0))))
        after_begin = F.element_at(F.split(line, BEGIN, -1), -1)
        inline = F.regexp_extract(after_begin, INLINE, 0)
        opened = state(acc, at=following, state=F.when(inline == "", 1).otherwise(2), b=start, e=at + n - long(F.length(after_begin)) + long(F.length(inline)))
        shut = state(acc, at=following, state=none, out=closed(acc, start, at + n - last(END)))
        begun = F.when(after_begin.rlike(END), shut).otherwise(opened)
        # inside a key
        bare = F.regexp_replace(line, EDGES, "")
        to_end = at + long(F.length(F.regexp_replace(line, r"\s+$", "")))
        ended = state(acc, at=following, state=none, out=closed(acc, acc["b"], at + n - last(END)))
        goes_on = state(acc, at=following, state=F.lit(2), e=to_end)
        last_line = state(acc, at=following, state=short, e=to_end)
        over = state(acc, at=following, state=none, out=closed(acc, acc["b"], acc["e"]))
        s = acc["state"]
        key_line = (F.when(line.rlike(END), ended)
                    .when((s >= 2) & line.rlike(CHECKSUM), last_line)
                    .when(bare == "", state(acc, at=following))
                    .when((s < 3) & bare.rlike(FULL), goes_on)
                    .when((s == 2) & bare.rlike(SHORT), last_line)
                    .when((s == 1) & line.rlike(HEADER), state(acc, at=following))
                    .otherwise(over))
        return F.when(line.rlike(BEGIN), begun).when(inside, key_line).otherwise(state(acc, at=following))

    found = F.aggregate(F.split(text, "\n"), begin, step, lambda acc: F.when(acc["state"] > 0, closed(acc, acc["b"], acc["e"])).otherwise(acc["out"]))
    return F.when(text.rlike(BEGIN), found).otherwise(F.array().cast("array<struct<b: bigint, e: bigint>>"))


def _holds(r: Rule) -> Column:
    found = F.col("text").rlike(r.pattern)
    return found if r.literal is None else F.contains("text", F.lit(r.literal)) & found


def _hits(rules: tuple[Rule, ...]) -> Column:
    """Per rule that matches: lengths of the gaps between matches, of the matches, and of the tested group."""

    def lengths(strings: Column) -> Column:
        return F.transform(strings, F.length)

    def of_keys(r: Rule) -> Column:
        def told(k: Column) -> Column:
            size = F.transform(k, lambda x: (x["e"] - x["b"]).cast("int"))
            gap = F.transform(k, lambda x, i: (x["b"] - F.coalesce(F.get(k, i - 1)["e"], F.lit(0))).cast("int"))
            return F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), gap.alias("gap"), size.alias("size"), size.alias("held"))
        return F.when(_holds(r), let(key_spans(F.col("text")), told))

    per_rule = [of_keys(r) if r.kind == "pem" else F.when(_holds(r), F.struct(
        F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"),
        lengths(F.split("text", r.pattern, -1)).alias("gap"),
        lengths(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias("size"),
        lengths(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group))).alias("held"))) for r in rules]
    return F.array_compact(F.array(*per_rule))


def _places(scanned: DataFrame) -> DataFrame:
    """(blob, kind, start, end) from the lengths: a running sum over each blob's matches of a kind."""
    one = (scanned.select("blob", F.explode("hits").alias("r"))
           .select("blob", "r.kind", "r.least", F.posexplode(F.arrays_zip("r.gap", "r.size", "r.held")).alias("n", "m"))
           .select("blob", "kind", "least", "n", "m.gap", F.coalesce("m.size", F.lit(0)).alias("size"), "m.held"))
    upto = Window.partitionBy("blob", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return (one.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(upto)).filter("held >= least")
            .select("blob", "kind", (F.col("end") - F.col("size")).alias("start"), "end"))


class Ledger:
    """The two folders of a ledger at ``path`` (any Hadoop URI that all executors share)."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        prepare(spark)
        self.spark, self.path, self.rules, self.version = spark, path.rstrip("/"), rules, rule_version(rules)

    def _read(self, part: str, schema: str) -> DataFrame:
        at = f"{self.path}/{part}"
        got = self.spark.read.schema(schema).parquet(at) if exists(self.spark, at) else self.spark.createDataFrame([], schema)
        return got.filter(F.col("rules") == self.version).drop("rules").distinct()

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, rules string")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, rules string, kind string, start long, end long")

    def scan(self, versions: DataFrame, text_col: str = "text") -> int:
        """Scan the blobs of ``versions`` that this rule version has not seen; returns how many there were."""
        blobs = versions.select(blob_id(F.col(text_col)).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        if exists(self.spark, f"{self.path}/scanned"):
            blobs = blobs.join(self.scanned(), "blob", "left_anti")
        # copies of a blob collapse in each task before the exchange, however many rows share it;
        # of a scanned text only match lengths are kept
        done = staged(blobs.dropDuplicates(["blob"]).select("blob", _hits(self.rules).alias("hits")), "scanned")
        mark = F.lit(self.version).alias("rules")
        _places(done).select("blob", mark, "kind", "start", "end").write.mode("append").parquet(f"{self.path}/findings")
        done.select("blob", mark).write.mode("append").parquet(f"{self.path}/scanned")
        return done.count()

    def spans(self) -> DataFrame:
        """(blob, spans): the findings of each blob that has any, by start, then rule order."""
        order = F.array_position(F.array(*[F.lit(r.kind) for r in self.rules]), F.col("kind"))
        each = F.array_sort(F.collect_list(F.struct("start", order.alias("rank"), "end", "kind")))
        return self.findings().groupBy("blob").agg(
            F.transform(each, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def scan_paths(versions: DataFrame, ledger: Ledger, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scan what is new, then one row per row of ``versions``: id, blob, spans (empty where nothing was found)."""
    ledger.scan(versions, text_col)
    found = staged(ledger.spans(), "spans")          # small; a blob that many paths hold can be split in the join
    paths = versions.select(F.col(id_col), blob_id(F.col(text_col)).alias("blob"))
    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")
    return paths.join(found, "blob", "left").select(F.col(id_col), "blob", F.coalesce("spans", none).alias("spans"))


def spans_text(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` joined by commas, of all kinds or the listed ones."""
    some = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones together) replaced by ``[kind]`` of its first finding."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        joined = F.struct(F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"), s["end"].alias("at"))
        longer = F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))
        return F.when(s["start"] >= acc["at"], joined).otherwise(longer)

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))))
