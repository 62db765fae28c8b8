"""Registered queries of the operators, thin over their whole tables, and their DuckDB SQL."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.session import work_path

from . import blocknames, collocations, gated_lm, langid, licenses, linedup, packing, periodic, quality, secret_ledger, simhash, spec_bpe, transcripts
from .common import documents, fold, prepare


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_quality(documents(spark, sf_dir))


def op2_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 7) == 2
    scored = gated_lm.score(documents(spark, sf_dir).select("doc_id", "text"), ~held_out)
    return scored.withColumn("held_out", held_out)


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    # a ledger of this call's own, so that the query scans every blob once whatever ran before
    ledger = secret_ledger.Ledger(spark, work_path(spark, "llm", spark.sparkContext.applicationId, f"ledger-{uuid.uuid4().hex[:12]}"))
    found = secret_ledger.scan_paths(documents(spark, sf_dir), ledger)
    spans, kinds = F.col("spans"), secret_ledger.BASE

    def of_kind(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    count = [of_kind(k) for k in kinds]
    return found.select("doc_id", *count, F.sha2(secret_ledger.spans_text(spans, kinds).cast("binary"), 256).alias("base_sha256"),
                        secret_ledger.spans_text(spans).alias("spans"))


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """``conversations`` as transcripts would show them: one of three marker styles a conversation, one marker in twenty missing.

    Columns conv_id, part, text: the lines of a transcript in their order, cut into parts where the table's rows are
    (``recover`` takes no notice of that; a conversation may be too long for one row).  The turn and role columns stay
    beside them for fitting and tests."""
    style = F.pmod(F.xxhash64(F.col("conv_id"), F.lit("style")), F.lit(3))
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(20)) == 0
    name = {0: {"user": "User", "assistant": "Assistant", "system": "System"}, 1: {"user": "Human", "assistant": "AI", "system": "Instructions"},
            2: {"user": "customer", "assistant": "agent", "system": "system"}}
    marker = F.lit("")
    for k, names in name.items():
        for role, n in names.items():
            marker = F.when((style == k) & (F.col("role") == role), f"[{n}] " if k == 2 else f"{n}: ").otherwise(marker)
    return conversations.select("conv_id", "turn", F.col("turn").alias("part"), "role", F.when(lost, F.col("text")).otherwise(F.concat(marker, "text")).alias("text"))


def op4_transcript_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transcripts(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
    held_out = fold("conv_id", 5) == 0
    model = transcripts.fit(raw.filter(~held_out))
    told = transcripts.recover(raw.select("conv_id", "part", "text"), model)
    return told.select("conv_id", "turn", held_out.alias("held_out"), "role", transcripts.render(F.col("text"), F.col("role")).alias("text"))


def op5_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    model = langid.fit(docs, ~held_out)
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocknames.duplicates(documents(spark, sf_dir))


def op7_license_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op8_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spec_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), decoded_col="decoded")
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op10_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def planted_tail(doc_id, n: int) -> tuple[int, int] | None:
    """The contract's rule: every tenth document (by crc32 of its id) repeats itself from one of its words on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or n == 0:
        return None
    g = h // 10
    start = g % n
    return start, 1 + (n - start) // (3 + g % 8)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(documents(spark, sf_dir), tail=planted_tail)
    order = lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"])).when(
        a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int")
    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")


def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linedup.drop_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_line_frequency, op2_gated_lm, op3_secret_ledger, op4_transcript_roles, op5_byte_cnn_language, op6_block_naming, op7_license_alignment,
    op8_speculative_bpe, op9_hilbert_packing, op10_covering_simhash, op11_collocations, op12_periodic_runs, op13_line_runs)}

_SPACE = r"[\x20\x09-\x0D]+"

_OP1 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '{_SPACE}'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(0, 5)) AS k FROM twice) GROUP BY r),
raw AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
lines AS (SELECT r, source, unnest(list_transform(string_split(regexp_replace(lower(t), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)), lambda x: trim(x, ' '))) AS l FROM d),
hosts AS (SELECT source, count(DISTINCT {{'i': doc_id, 't': t}}) AS n FROM d GROUP BY source),
freq AS (SELECT src AS source, l FROM (SELECT lines.source AS src, l, count(DISTINCT {{'i': doc_id, 't': t}}) AS c FROM lines JOIN d USING (r) WHERE l <> '' GROUP BY lines.source, l)
  JOIN hosts ON hosts.source IS NOT DISTINCT FROM src WHERE c > 5 AND c > 0.05 * n),
gone AS (SELECT r, count(*) AS n, sum(len(string_split(lines.l, ' '))) AS m FROM lines JOIN freq ON lines.l = freq.l AND lines.source IS NOT DISTINCT FROM freq.source GROUP BY r),
x AS (SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(raw.ls) - len(list_distinct(raw.ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_lines, CAST(coalesce(gone.m, 0) AS BIGINT) AS removed_words
  FROM d JOIN w USING (r) JOIN raw USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)),
y AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  removed_words > 0.5 * n_words OR (removed_words > 0 AND n_words - removed_words < 10) AS depleted FROM x)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM y
"""

_ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
           r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


def _keys_sql() -> str:
    """(r, b, e): private keys of ``d`` by the same fold over lines as ``secret_ledger.key_spans``."""
    L = secret_ledger
    q = lambda p: "'" + p.replace("'", "''") + "'"
    last = lambda p: f"length(string_split_regex(x.line, {q(p)})[-1])"

    def state(**new):
        return "{'line': '', " + ", ".join(f"'{c}': {new.get(c, f'a.{c}')}" for c in ("at", "state", "b", "e", "out")) + "}"

    n, following = "length(x.line)", "a.at + length(x.line) + 1"
    start = f"CASE WHEN a.state > 0 THEN a.b ELSE a.at + length(string_split_regex(x.line, {q(L.BEGIN)})[1]) END"
    after = f"string_split_regex(x.line, {q(L.BEGIN)})[-1]"
    inline = f"regexp_extract({after}, {q(L.INLINE)})"
    bare = f"regexp_replace(x.line, {q(L.EDGES)}, '', 'g')"
    to_end = "a.at + length(regexp_replace(x.line, '\\s+$', ''))"

    def shut(b, e):
        return f"list_append(a.out, {{'b': {b}, 'e': {e}}})"

    opened = state(at=following, state=f"CASE WHEN {inline} = '' THEN 1 ELSE 2 END", b=start, e=f"a.at + {n} - length({after}) + length({inline})")
    ended = f"a.at + {n} - {last(L.END)}"
    step = f"""CASE WHEN regexp_matches(x.line, {q(L.BEGIN)}) THEN
    CASE WHEN regexp_matches({after}, {q(L.END)}) THEN {state(at=following, state='0', out=shut(start, ended))} ELSE {opened} END
  WHEN a.state = 0 THEN {state(at=following)}
  WHEN regexp_matches(x.line, {q(L.END)}) THEN {state(at=following, state='0', out=shut('a.b', ended))}
  WHEN a.state >= 2 AND regexp_matches(x.line, {q(L.CHECKSUM)}) THEN {state(at=following, state='3', e=to_end)}
  WHEN {bare} = '' THEN {state(at=following)}
  WHEN a.state < 3 AND regexp_matches({bare}, {q(L.FULL)}) THEN {state(at=following, state='2', e=to_end)}
  WHEN a.state = 2 AND regexp_matches({bare}, {q(L.SHORT)}) THEN {state(at=following, state='3', e=to_end)}
  WHEN a.state = 1 AND regexp_matches(x.line, {q(L.HEADER)}) THEN {state(at=following)}
  ELSE {state(at=following, state='0', out=shut('a.b', 'a.e'))} END"""
    shape = "STRUCT(line VARCHAR, \"at\" BIGINT, state BIGINT, b BIGINT, e BIGINT, \"out\" STRUCT(b BIGINT, e BIGINT)[])"
    first = "{'line': %s, 'at': 0, 'state': 0, 'b': 0, 'e': 0, 'out': []}"
    return f"""SELECT r, unnest(CASE WHEN z.state > 0 THEN list_append(z.out, {{'b': z.b, 'e': z.e}}) ELSE z.out END, recursive := true) FROM (
  SELECT r, list_reduce(list_transform(string_split(t, chr(10)), lambda v: CAST({first % 'v'} AS {shape})),
    lambda a, x: CAST({step} AS {shape}), CAST({first % "''"} AS {shape})) AS z FROM d WHERE regexp_matches(t, {q(L.BEGIN)}))"""


def _op3() -> str:
    kinds = [("assign", _ASSIGN, 2, 6), *((r.kind, r.pattern.replace("'", "''"), r.group, r.least) for r in secret_ledger.RULES[1:])]
    parts = " UNION ALL ".join(
        f"SELECT r, '{k}' AS kind, {i} AS rank, {least} AS least, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {g}) AS h, "
        f"string_split_regex(t, '{p}') AS g FROM d" for i, (k, p, g, least) in enumerate(kinds) if k != "pem")
    pem = next(i for i, (k, *_) in enumerate(kinds) if k == "pem")
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secret_ledger.BASE)
    base = "', '".join(secret_ledger.BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
a AS ({parts}),
b AS (SELECT r, kind, rank, m, h, g, least, unnest(range(1, len(m) + 1)) AS n FROM a WHERE len(m) > 0),
keys AS ({_keys_sql()}),
c AS (SELECT r, kind, rank, CAST(list_sum(list_transform(g[1:n], lambda x: length(x))) + list_sum(list_transform(m[1:n], lambda x: length(x))) AS BIGINT) AS e,
  length(m[n]) AS size FROM b WHERE length(h[n]) >= least
  UNION ALL SELECT r, 'pem', {pem}, e, e - b FROM keys),
s AS (SELECT r, {counts},
  string_agg(kind || ':' || (e - size) || ':' || e, ',' ORDER BY e - size, rank) FILTER (kind IN ('{base}')) AS base,
  string_agg(kind || ':' || (e - size) || ':' || e, ',' ORDER BY e - size, rank) AS spans FROM c GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_ledger.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (r)
"""


_OP6 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

_OP11 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.*, x.a AS l, y.a AS r, CAST(1000000 * c.a::HUGEINT * c.a::HUGEINT // (x.a::HUGEINT * y.a::HUGEINT) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
u AS (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM f WHERE k = 3),
m AS (SELECT lang, phrase, max(a) AS longer FROM u GROUP BY lang, phrase),
z AS (SELECT b.* FROM b LEFT JOIN m USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT * FROM (SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n.n, score
  FROM z JOIN n ON n.lang = z.lang) WHERE rank <= 2000
"""

_OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS pos FROM d),
k AS (SELECT r, line, pos, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (r) GROUP BY r
"""

ORACLE = {"op1_line_frequency": _OP1, "op3_secret_ledger": _op3(), "op6_block_naming": _OP6, "op11_collocations": _OP11, "op13_line_runs": _OP13}
