"""DuckDB oracle SQL for the registered queries.

Views available to the SQL: region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations.  The SQL recomputes every stand-in table from
those views; money is summed in integer cents on both sides so means do not depend on
summation order.
"""

from __future__ import annotations

from scorewright.plans.fixed import CHURN_INTERCEPT, CHURN_NUMERIC_WEIGHTS, FIXED_TREES, FIXED_WEIGHTS
from scorewright.sources.tables import (BAD_INT_EVERY, BLANK_EVERY, CHURN_CUTOFF, CUTOFF_MONTH_INDEX, MALFORMED_EVERY, OPEN_QUOTE, TOO_FEW,
                                        TOO_MANY)
from scorewright.specs import CHURN

ORACLE: dict[str, str] = {}


def sql(name: str):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


CUT = f"TIMESTAMP '{CHURN_CUTOFF} 00:00:00'"

# churn stand-in (same columns as sources.tables.churn_table)
CHURN_CTE = f"""
_pp AS (
  SELECT o_custkey, o_orderpriority,
         count(*) FILTER (WHERE o_orderdate < {CUT}) AS cnt,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (WHERE o_orderdate < {CUT}) AS cents,
         min(o_orderdate) FILTER (WHERE o_orderdate < {CUT}) AS first_date,
         max(CASE WHEN o_orderdate < {CUT} THEN 0 ELSE 1 END) AS after
  FROM orders GROUP BY o_custkey, o_orderpriority),
_mode AS (
  SELECT o_custkey, o_orderpriority AS p FROM (
    SELECT o_custkey, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey ORDER BY cnt DESC, o_orderpriority) AS rn
    FROM _pp WHERE cnt > 0) WHERE rn = 1),
_pc AS (
  SELECT o_custkey, sum(cnt) AS n, sum(cents) AS cents, min(first_date) AS first_date, max(after) AS after
  FROM _pp GROUP BY o_custkey),
churn AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customerID, c.c_custkey AS custkey,
         c.c_mktsegment AS segment, n.n_name AS nation, r.r_name AS region, m.p AS top_priority,
         CAST(coalesce(a.n, 0) AS INTEGER) AS n_orders,
         CAST(CASE WHEN a.first_date IS NULL THEN 0
              ELSE {CUTOFF_MONTH_INDEX} - (year(a.first_date) * 12 + month(a.first_date)) END AS INTEGER) AS tenure,
         CASE WHEN coalesce(a.n, 0) > 0
              THEN CAST(a.cents AS DOUBLE) / (CAST(a.n AS DOUBLE) * CAST(100 AS DOUBLE))
              ELSE CAST(0 AS DOUBLE) END AS avg_order,
         CAST(coalesce(a.cents, 0) AS DOUBLE) / CAST(100 AS DOUBLE) AS total_spent,
         c.c_acctbal AS acctbal,
         CASE WHEN coalesce(a.after, 0) = 0 THEN 'Yes' ELSE 'No' END AS churn
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN _pc a ON a.o_custkey = c.c_custkey
  LEFT JOIN _mode m ON m.o_custkey = c.c_custkey)"""

# the churn CSV after the scoring-path cleaning (blank -> 0.0, bad int -> 0)
CHURN_ZERO_CTE = CHURN_CTE + f""",
churn_zero AS (
  SELECT customerID, custkey, segment, nation, region, top_priority, n_orders,
         CASE WHEN custkey % {BAD_INT_EVERY} = 0 THEN 0 ELSE tenure END AS tenure,
         avg_order,
         CASE WHEN custkey % {BLANK_EVERY} = 0 THEN CAST(0 AS DOUBLE) ELSE total_spent END AS total_spent,
         acctbal, churn
  FROM churn)"""


def vocab_ctes(src: str, columns: list[str]) -> str:
    """StringIndexer order: frequency desc, value asc; nulls are not labels."""
    parts = []
    for c in columns:
        parts.append(f"""_v_{c} AS (
  SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS i
  FROM {src} WHERE {c} IS NOT NULL GROUP BY {c})""")
    return ",\n".join(parts)


def indexed_cte(src: str, columns: list[str], name: str = "indexed") -> str:
    """``src`` plus ``<c>_i`` (index or NULL) and ``<c>_off`` (offset of the one-hot block)."""
    joins = "\n  ".join(f"LEFT JOIN _v_{c} ON {src}.{c} = _v_{c}.v" for c in columns)
    sel = []
    offset = str(len(CHURN.numeric))
    for c in columns:
        sel.append(f"_v_{c}.i AS {c}_i")
        sel.append(f"({offset}) AS {c}_off")
        offset = f"{offset} + (SELECT count(*) FROM _v_{c})"
    return f"""{name} AS (
  SELECT {src}.*, {', '.join(sel)}
  FROM {src}
  {joins})"""


def onehot_weight_sql(j: str) -> str:
    return f"CAST(((({j}) * 37) % 19) - 9 AS DOUBLE) / CAST(20 AS DOUBLE)"


def churn_raw_sql(numeric_weights=CHURN_NUMERIC_WEIGHTS, intercept=CHURN_INTERCEPT) -> str:
    """Left-to-right dot product over [numerics, one-hot blocks] + intercept."""
    acc = "CAST(0 AS DOUBLE)"
    for c, w in zip(CHURN.numeric, numeric_weights):
        acc = f"({acc} + CAST({c} AS DOUBLE) * {dbl(w)})"
    for c in CHURN.categorical:
        acc = (f"({acc} + CASE WHEN {c}_i IS NULL THEN CAST(0 AS DOUBLE) "
               f"ELSE {onehot_weight_sql(f'{c}_off + {c}_i')} END)")
    return f"({acc} + {dbl(intercept)})"


def churn_scored_cte(numeric_weights=CHURN_NUMERIC_WEIGHTS, intercept=CHURN_INTERCEPT) -> str:
    return (CHURN_ZERO_CTE + ",\n" + vocab_ctes("churn_zero", CHURN.categorical) + ",\n"
            + indexed_cte("churn_zero", CHURN.categorical) + f""",
scored AS (
  SELECT *, 1 / (1 + exp(-raw)) AS probability FROM (
    SELECT *, {churn_raw_sql(numeric_weights, intercept)} AS raw FROM indexed)),
pred AS (
  SELECT *, CASE WHEN probability >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
         CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label
  FROM scored)""")


@sql("score_ids")
def _score_ids() -> str:
    return f"""WITH {churn_scored_cte()}
SELECT customerID AS id, CASE WHEN prediction = 1 THEN 'yes' ELSE 'no' END AS churn FROM pred"""


def confusion_sql(src: str, group: list[str] = ()) -> str:
    g = ", ".join(group)
    gsel = f"{g}, " if group else ""
    gby = f"GROUP BY {g}" if group else ""
    return f"""SELECT {gsel}tp, fp, fn, tn,
       CAST(correct AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy,
       CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS precision,
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS f1
FROM (SELECT {gsel}
        count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
        count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
        count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
        count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn,
        count(*) FILTER (WHERE label = prediction) AS correct,
        count(*) AS n
      FROM {src} {gby})"""


def auc_sql(src: str, score: str, group: list[str] = ()) -> str:
    g = ", ".join(group)
    gsel = f"{g}, " if group else ""
    gby = f"GROUP BY {g}" if group else ""
    part = f"PARTITION BY {g} " if group else ""
    return f"""SELECT {gsel}CASE WHEN sum(pos) > 0 AND sum(neg) > 0
         THEN sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + 0.5 * CAST(neg AS DOUBLE)))
              / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc
FROM (SELECT {gsel}pos, neg,
             coalesce(sum(neg) OVER ({part}ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {gsel}{score} AS sc, sum(label) AS pos, sum(1 - label) AS neg FROM {src} GROUP BY {gsel}{score}))
{gby}"""


@sql("prediction_counts")
def _prediction_counts() -> str:
    return f"""WITH {churn_scored_cte()}
SELECT count(*) AS total, count(*) FILTER (WHERE prediction = 0) AS stay,
       count(*) FILTER (WHERE prediction = 1) AS leave FROM pred"""


@sql("accuracy")
def _accuracy() -> str:
    return f"""WITH {churn_scored_cte()}
SELECT CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS accuracy FROM pred"""


@sql("binary_metrics")
def _binary_metrics() -> str:
    return f"WITH {churn_scored_cte()}\n{confusion_sql('pred')}"


@sql("auc")
def _auc() -> str:
    return f"WITH {churn_scored_cte()}\n{auc_sql('pred', 'raw')}"


def rules_stacked_cte() -> str:
    from scorewright.plans.fixed import CHURN_ALT_RULES

    parts = [f"SELECT '{name}' AS model, customerID, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label, "
             f"{churn_raw_sql(w, b)} AS raw FROM indexed" for name, (w, b) in CHURN_ALT_RULES.items()]
    union = "\n  UNION ALL ".join(parts)
    return (CHURN_ZERO_CTE + ",\n" + vocab_ctes("churn_zero", CHURN.categorical) + ",\n"
            + indexed_cte("churn_zero", CHURN.categorical) + f""",
st AS (
  {union}),
st_pred AS (
  SELECT *, CASE WHEN 1 / (1 + exp(-raw)) >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction
  FROM st)""")


@sql("compare_metrics")
def _compare_metrics() -> str:
    return f"""WITH {rules_stacked_cte()},
conf AS ({confusion_sql('st_pred', ['model'])}),
a AS ({auc_sql('st_pred', 'raw', ['model'])})
SELECT conf.*, a.auc FROM conf JOIN a USING (model)"""


@sql("stack_predictions")
def _stack_predictions() -> str:
    return f"""WITH {rules_stacked_cte()}
SELECT model, prediction, count(*) AS n FROM st_pred GROUP BY model, prediction"""


@sql("decision_text")
def _decision_text() -> str:
    return f"""WITH {churn_scored_cte()}
SELECT customerID, CASE WHEN prediction = 1 THEN 'leave' ELSE 'stay' END AS decision,
       printf('%.2f%%', probability * 100) AS leave_probability FROM pred"""


@sql("confidence_modes")
def _confidence_modes() -> str:
    return f"""WITH {churn_scored_cte()}
SELECT customerID, round(probability, 6) AS conf_positive,
       round(CASE WHEN prediction = 1 THEN probability ELSE 1 - probability END, 6) AS conf_predicted FROM pred"""


@sql("preview_scored")
def _preview_scored() -> str:
    return f"""WITH {churn_scored_cte()}
SELECT customerID, segment, nation, churn, prediction, round(probability, 6) AS probability
FROM pred ORDER BY custkey LIMIT 10"""


@sql("row_ids")
def _row_ids() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID, row_number() OVER (ORDER BY custkey) AS row_id FROM churn"""


TEN = f"custkey % {BLANK_EVERY} = 0"
BAD = f"custkey % {BAD_INT_EVERY} = 0"


@sql("scan_csv")
def _scan_csv() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID, segment, nation, region, top_priority, n_orders,
       CASE WHEN {BAD} THEN NULL ELSE tenure END AS tenure, avg_order,
       CASE WHEN {TEN} THEN NULL ELSE total_spent END AS total_spent, acctbal, churn
FROM churn"""


@sql("scan_csv_strings")
def _scan_csv_strings() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID, segment, nation, region, top_priority, CAST(n_orders AS VARCHAR) AS n_orders,
       CASE WHEN {BAD} THEN 'x' ELSE CAST(tenure AS VARCHAR) END AS tenure, churn
FROM churn"""


@sql("clean_blank_drop")
def _clean_blank_drop() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID, segment, nation, region, top_priority, n_orders,
       CASE WHEN {BAD} THEN NULL ELSE tenure END AS tenure, avg_order, total_spent, acctbal,
       CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label
FROM churn WHERE NOT ({TEN})"""


@sql("clean_blank_zero")
def _clean_blank_zero() -> str:
    return f"""WITH {CHURN_ZERO_CTE}
SELECT customerID, segment, nation, region, top_priority, n_orders, tenure, avg_order, total_spent, acctbal, churn
FROM churn_zero"""


@sql("typed_casts")
def _typed_casts() -> str:
    return _scan_csv()


@sql("derive_label")
def _derive_label() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label FROM churn"""


@sql("quarantine_rows")
def _quarantine_rows() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID,
       CASE WHEN {BAD} OR {TEN} THEN 'rejected' ELSE 'ok' END AS status,
       concat_ws('; ', CASE WHEN {BAD} THEN 'tenure: not a valid int: ''x''' END,
                       CASE WHEN {TEN} THEN 'total_spent: missing' END) AS error,
       CASE WHEN {BAD} THEN NULL ELSE tenure END AS tenure,
       CASE WHEN {TEN} THEN NULL ELSE total_spent END AS total_spent
FROM churn"""


def _indexed_zero() -> str:
    return (CHURN_ZERO_CTE + ",\n" + vocab_ctes("churn_zero", CHURN.categorical) + ",\n"
            + indexed_cte("churn_zero", CHURN.categorical))


@sql("string_index")
def _string_index() -> str:
    cols = ", ".join(f"coalesce({c}_i, CAST((SELECT count(*) FROM _v_{c}) AS INTEGER)) AS {c}_idx"
                     for c in CHURN.categorical)
    return f"WITH {_indexed_zero()}\nSELECT customerID, {cols} FROM indexed"


@sql("one_hot")
def _one_hot() -> str:
    cols = ", ".join(f"coalesce({c}_i, -1) AS {c}_hot" for c in CHURN.categorical)
    return f"WITH {_indexed_zero()}\nSELECT customerID, {cols} FROM indexed"


@sql("assemble")
def _assemble() -> str:
    size = f"{len(CHURN.numeric)}" + "".join(f" + (SELECT count(*) FROM _v_{c})" for c in CHURN.categorical)
    nnz = " + ".join([*[f"CASE WHEN {c} <> 0 THEN 1 ELSE 0 END" for c in CHURN.numeric],
                      *[f"CASE WHEN {c}_i IS NULL THEN 0 ELSE 1 END" for c in CHURN.categorical]])
    acc = "CAST(0 AS DOUBLE)"
    for j, c in enumerate(CHURN.numeric):
        acc = f"({acc} + CAST({c} AS DOUBLE) * CAST({j + 1} AS DOUBLE))"
    for c in CHURN.categorical:
        acc = f"({acc} + CASE WHEN {c}_i IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST({c}_off + {c}_i + 1 AS DOUBLE) END)"
    return f"""WITH {_indexed_zero()}
SELECT customerID, CAST({size} AS INTEGER) AS n_features, CAST({nnz} AS INTEGER) AS nnz, {acc} AS checksum
FROM indexed"""


@sql("standard_scale")
def _standard_scale() -> str:
    cols = ", ".join(f"round(CAST({c} AS DOUBLE) / stddev_samp(CAST({c} AS DOUBLE)) OVER (), 6) AS {c}"
                     for c in CHURN.numeric)
    return f"WITH {CHURN_ZERO_CTE}\nSELECT customerID, {cols} FROM churn_zero"


@sql("holdout_split")
def _holdout_split() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID, CASE WHEN substr(md5('42:' || CAST(custkey AS VARCHAR)), 1, 4) < 'cccd'
                        THEN 'train' ELSE 'test' END AS split FROM churn"""


@sql("replicate")
def _replicate() -> str:
    return f"""WITH {CHURN_CTE}
SELECT customerID, churn, CAST(t.copy AS INTEGER) AS copy FROM churn, range(200) AS t(copy)"""


# ---------------------------------------------------------------- embeddings, labels, sinks
EMB_SCORED_CTE = """
_e AS (SELECT vec_id, label, 'class_' || CAST(label AS VARCHAR) AS class_name,
              CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
_es AS (SELECT *, list_dot_product(x, list_transform(range(len(x)),
                    lambda j: CAST(((j * 7) % 11) - 5 AS DOUBLE) / CAST(10 AS DOUBLE))) + CAST('0.1' AS DOUBLE) AS raw
        FROM _e),
emb_pred AS (SELECT *, CASE WHEN probability >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction
             FROM (SELECT *, 1 / (1 + exp(-raw)) AS probability FROM _es)),
label_map AS (
  SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, 'class_' || CAST(label AS VARCHAR)) - 1 AS INTEGER) AS index,
         'class_' || CAST(label AS VARCHAR) AS label
  FROM embeddings GROUP BY label)"""


@sql("linear_score")
def _linear_score() -> str:
    return f"WITH {EMB_SCORED_CTE}\nSELECT vec_id, prediction, round(probability, 6) AS probability FROM emb_pred"


@sql("class_counts")
def _class_counts() -> str:
    return "SELECT label, count(*) AS count FROM embeddings GROUP BY label"


@sql("class_weights")
def _class_weights() -> str:
    return """WITH c AS (SELECT label, count(*) AS cnt FROM embeddings GROUP BY label),
w AS (SELECT label, CAST(sum(cnt) OVER () AS DOUBLE) / (CAST(count(*) OVER () AS DOUBLE) * CAST(cnt AS DOUBLE))
             AS classWeight FROM c)
SELECT e.vec_id, e.label, coalesce(w.classWeight, CAST(1 AS DOUBLE)) AS classWeight
FROM embeddings e LEFT JOIN w ON e.label = w.label"""


@sql("feature_filter")
def _feature_filter() -> str:
    return """SELECT vec_id, label FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v <> 0)) > 0"""


def _ext_sql() -> str:
    from scorewright.plans.fixed import NAME_EXTENSIONS
    lst = "[" + ", ".join(f"'{x}'" for x in NAME_EXTENSIONS) + "]"
    return f"lower({lst}[CAST(vec_id % {len(NAME_EXTENSIONS)} AS INTEGER) + 1])"


@sql("path_label")
def _path_label() -> str:
    return "SELECT vec_id, 'class_' || CAST(label AS VARCHAR) AS label FROM embeddings"


@sql("file_extension")
def _file_extension() -> str:
    from scorewright.specs import IMAGE_EXTENSIONS
    exts = ", ".join(f"'{x}'" for x in IMAGE_EXTENSIONS)
    return f"SELECT vec_id, {_ext_sql()} AS ext, {_ext_sql()} IN ({exts}) AS is_image FROM embeddings"


@sql("sink_label_map")
def _sink_label_map() -> str:
    return f"WITH {EMB_SCORED_CTE}\nSELECT index, label FROM label_map"


for _name in ("label_map", "label_map_tolerant", "label_map_object"):
    ORACLE[_name] = ORACLE["sink_label_map"]


@sql("label_lookup")
def _label_lookup() -> str:
    return f"""WITH {EMB_SCORED_CTE}
SELECT p.vec_id, coalesce(m.label, CAST(CAST(p.prediction AS INTEGER) AS VARCHAR)) AS label_name
FROM emb_pred p LEFT JOIN label_map m ON m.index = CAST(p.prediction AS INTEGER)"""


@sql("sink_metrics_json")
def _sink_metrics_json() -> str:
    return f"""WITH {EMB_SCORED_CTE}
SELECT CAST(count(*) FILTER (WHERE CAST(CASE WHEN label < 5 THEN 1 ELSE 0 END AS DOUBLE) = prediction) AS DOUBLE)
       / CAST(count(*) AS DOUBLE) AS accuracy FROM emb_pred"""


@sql("sink_single_csv")
def _sink_single_csv() -> str:
    return f"""WITH {EMB_SCORED_CTE}
SELECT 'img,' || CAST(p.vec_id AS VARCHAR) || '.png' AS filename,
       coalesce(m.label, CAST(CAST(p.prediction AS INTEGER) AS VARCHAR)) AS label,
       round(p.probability, 6) AS confidence
FROM emb_pred p LEFT JOIN label_map m ON m.index = CAST(p.prediction AS INTEGER)"""


ORACLE["sink_scores_csv"] = ORACLE["score_ids"]


# ---------------------------------------------------------------- wholesale
def _wholesale_cte() -> str:
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    cols = ",\n         ".join(
        f"CAST(coalesce(sum(cents) FILTER (WHERE ptype = '{c}'), 0) AS DOUBLE) / CAST(100 AS DOUBLE) AS {c}"
        for c in W)
    return f"""
_li AS (SELECT o.o_custkey, lower(split_part(p.p_type, ' ', 1)) AS ptype,
               CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey),
wholesale AS (
  SELECT o_custkey AS custkey,
         {cols}
  FROM _li GROUP BY o_custkey),
wz AS (
  SELECT *, {", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z_{c}" for c in W)}
  FROM wholesale)"""


def _assigned_cte() -> str:
    from scorewright.plans.fixed import wholesale_centres
    from scorewright.specs import KMEANS_PARAMS
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    cs = wholesale_centres(KMEANS_PARAMS["k"], len(W))
    ds = []
    for cen in cs:
        acc = "CAST(0 AS DOUBLE)"
        for c, v in zip(W, cen):
            acc = f"({acc} + (z_{c} - {dbl(v)}) * (z_{c} - {dbl(v)}))"
        ds.append(acc)
    lst = "[" + ", ".join(ds) + "]"
    return _wholesale_cte() + f""",
assigned AS (
  SELECT *, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS prediction FROM (SELECT *, {lst} AS d FROM wz))"""


@sql("standard_scale_centered")
def _standard_scale_centered() -> str:
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    return f"WITH {_wholesale_cte()}\nSELECT custkey, {', '.join(f'round(z_{c}, 6) AS {c}' for c in W)} FROM wz"


@sql("assign_cluster")
def _assign_cluster() -> str:
    return f"WITH {_assigned_cte()}\nSELECT custkey, prediction FROM assigned"


@sql("cluster_profile")
def _cluster_profile() -> str:
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    avgs = ", ".join(f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * "
                     f"CAST(100 AS DOUBLE)) AS avg_{c}" for c in W)
    return f"WITH {_assigned_cte()}\nSELECT prediction, count(*) AS size, {avgs} FROM assigned GROUP BY prediction"


@sql("silhouette")
def _silhouette() -> str:
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    sq = " + ".join(f"z_{c} * z_{c}" for c in W)
    sums = ", ".join(f"sum(z_{c}) AS s_{c}" for c in W)
    dotp = " + ".join(f"p.z_{c} * st.s_{c}" for c in W)
    return f"""WITH {_assigned_cte()},
pts AS (SELECT custkey, prediction AS k, {', '.join(f'z_{c}' for c in W)}, {sq} AS sq FROM assigned),
st AS (SELECT k, count(*) AS n, sum(sq) AS sqs, {sums} FROM pts GROUP BY k),
d AS (SELECT p.custkey, p.k AS own, st.k AS other, CAST(st.n AS DOUBLE) AS n,
             p.sq + st.sqs / st.n - 2 * ({dotp}) / st.n AS dist FROM pts p, st),
agg AS (SELECT custkey, max(CASE WHEN own = other THEN dist END) AS own_d,
               max(CASE WHEN own = other THEN n END) AS own_n,
               min(CASE WHEN own <> other THEN dist END) AS other_d FROM d GROUP BY custkey),
s AS (SELECT CASE WHEN own_n = 1 THEN 0.0 WHEN a < other_d THEN 1 - a / other_d
                  WHEN a > other_d THEN other_d / a - 1 ELSE 0.0 END AS s
      FROM (SELECT *, own_d * own_n / (own_n - 1) AS a FROM agg))
SELECT round(avg(s), 6) AS silhouette FROM s"""


def _member_name_sql() -> str:
    from scorewright.sources.tables import ARCHIVE_SIZE, COMMA_EVERY, UPPER_EVERY
    return f"""('batch_' || CAST(vec_id // {ARCHIVE_SIZE} AS VARCHAR) || '/'
       || CASE WHEN vec_id % {COMMA_EVERY} = 0 THEN 'img,' ELSE 'img_' END || CAST(vec_id AS VARCHAR)
       || CASE WHEN vec_id % {UPPER_EVERY} = 1 THEN '.PNG' ELSE '.png' END)"""


def _corrupt_sql() -> str:
    from scorewright.sources.tables import CORRUPT_AT, CORRUPT_EVERY
    return f"vec_id % {CORRUPT_EVERY} = {CORRUPT_AT}"


@sql("error_rows")
def _error_rows() -> str:
    return f"""SELECT {_member_name_sql()} AS filename, 'ERROR' AS label, CAST(0 AS DOUBLE) AS confidence
FROM embeddings WHERE {_corrupt_sql()}"""


@sql("zip_members")
def _zip_members() -> str:
    from scorewright.sources.tables import ARCHIVE_SIZE
    return f"""SELECT 'archive_' || CAST(vec_id // {ARCHIVE_SIZE} AS VARCHAR) || '.zip' AS archive,
       {_member_name_sql()} AS name, CAST(NULL AS VARCHAR) AS error
FROM embeddings"""


@sql("scan_images")
def _scan_images() -> str:
    side = "CAST(ceil(sqrt(len(embedding))) AS INTEGER)"
    return f"""SELECT vec_id, CASE WHEN label < 5 THEN 'cat' ELSE 'dog' END AS label,
       CASE WHEN {_corrupt_sql()} THEN -1 ELSE {side} END AS height,
       CASE WHEN {_corrupt_sql()} THEN -1 ELSE {side} END AS width,
       CASE WHEN {_corrupt_sql()} THEN -1 ELSE 3 END AS nChannels
FROM embeddings"""


@sql("image_features")
def _image_features() -> str:
    """Pictures by their formula, resized and summed in integers: red from the value, green 255 less, blue from the class."""
    from scorewright.operators.embed import DEFAULT_GRID as g
    from scorewright.operators.embed import SIZE as s
    unit, whole = 2 * s, 4 * s * s
    return f"""WITH pic AS (
  SELECT vec_id, CASE WHEN label < 5 THEN 64 ELSE 192 END AS blue, side,
         list_transform(range(side * side), lambda i: CASE WHEN i < len(embedding) THEN
           CAST(greatest(0, least(255, round_even(128 + 400 * CAST(embedding[i + 1] AS DOUBLE), 0))) AS INTEGER) ELSE 0 END) AS p
  FROM (SELECT *, CAST(ceil(sqrt(len(embedding))) AS BIGINT) AS side FROM embeddings) WHERE NOT ({_corrupt_sql()})),
spot AS (SELECT side, j, a // {unit} AS low, least(a // {unit} + 1, side - 1) AS high, a % {unit} AS f
  FROM (SELECT side, j, greatest(0, least({unit} * (side - 1), (2 * j + 1) * side - {s})) AS a
        FROM (SELECT DISTINCT side FROM pic), range({s}) AS t(j))),
strips AS (SELECT vec_id, blue, side, y.j AS y, list_transform(range(side), lambda x:
    p[y.low * side + x + 1] * ({unit} - y.f) + p[y.high * side + x + 1] * y.f) AS r FROM pic JOIN spot AS y USING (side)),
px AS (SELECT vec_id, blue, y, x.j AS x, r[x.low + 1] * ({unit} - x.f) + r[x.high + 1] * x.f AS v FROM strips JOIN spot AS x USING (side)),
rgb AS (SELECT vec_id, blue, y, x, (v + {whole // 2}) // {whole} AS red, (255 * {whole} - v + {whole // 2}) // {whole} AS green FROM px),
cell AS (SELECT vec_id, blue, y * {g} // {s} AS cy, x * {g} // {s} AS cx, count(*) AS n, sum(red) AS red, sum(green) AS green,
    sum(red * red) AS red2, sum(green * green) AS green2 FROM rgb GROUP BY ALL),
pict AS (SELECT vec_id, sum(n) AS n, sum(red) AS red, sum(green) AS green, sum(red2) AS red2, sum(green2) AS green2 FROM cell GROUP BY vec_id),
f AS (SELECT vec_id, (cy * {g} + cx) * 3 + c AS place, [CAST(red AS DOUBLE), CAST(green AS DOUBLE), CAST(blue * n AS DOUBLE)][c + 1] / (n * 255.0::DOUBLE) AS value
    FROM cell, range(3) AS t(c)
  UNION ALL SELECT vec_id, {3 * g * g} + c, [sqrt(CAST(n * red2 - red * red AS DOUBLE)), sqrt(CAST(n * green2 - green * green AS DOUBLE)), 0][c + 1] / (n * 255.0::DOUBLE)
    FROM pict, range(3) AS t(c))
SELECT vec_id, CAST(NULL AS VARCHAR) AS error, CAST(place AS INTEGER) AS place, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM f
UNION ALL SELECT vec_id, 'undecodable image', NULL, NULL FROM embeddings WHERE {_corrupt_sql()}"""


@sql("wholesale_spend")
def _wholesale_spend() -> str:
    from scorewright.specs import WHOLESALE_STANDIN_COLUMNS as W
    return f"WITH {_wholesale_cte()}\nSELECT custkey, {', '.join(W)} FROM wholesale"


@sql("plot_sample_keyed")
def _plot_sample_keyed() -> str:
    from scorewright.operators.split import threshold_hex
    return f"""WITH {_assigned_cte()}
SELECT custkey, medium, standard, prediction FROM assigned
WHERE substr(md5('sample42:' || CAST(custkey AS VARCHAR)), 1, 4) < '{threshold_hex(0.1)}'"""


ORACLE["wholesale_plot_all"] = f"""WITH {_assigned_cte()}
SELECT custkey, medium, standard, prediction FROM assigned"""


# ---------------------------------------------------------------- batch report, image folder
_ROWS = "numbered AS (SELECT custkey AS _c, row_number() OVER (ORDER BY custkey) AS row FROM churn)"
ORACLE["batch_report_scored"] = f"""WITH {churn_scored_cte()}, {_ROWS}
SELECT row, customerID AS id, prediction, round(probability, 6) AS probability FROM pred JOIN numbered ON custkey = _c
WHERE NOT ({TEN}) AND NOT ({BAD}) AND {" AND ".join(f"{c} IS NOT NULL" for c in CHURN.categorical)}"""
ORACLE["batch_report_issues"] = f"""WITH {CHURN_CTE}, {_ROWS}
SELECT row, 'tenure: not a valid int: ''x''' AS error FROM churn JOIN numbered ON custkey = _c WHERE {BAD}
UNION ALL SELECT row, 'total_spent: missing' AS error FROM churn JOIN numbered ON custkey = _c WHERE {TEN}
{" ".join(f"UNION ALL SELECT row, '{c}: missing' AS error FROM churn JOIN numbered ON custkey = _c WHERE {c} IS NULL" for c in CHURN.categorical)}"""


# ---------------------------------------------------------------- malformed lines
MALFORMED_LINE = f"custkey % {MALFORMED_EVERY} IN ({TOO_FEW}, {TOO_MANY}, {OPEN_QUOTE})"
ORACLE["batch_report_malformed"] = f"""WITH {CHURN_ZERO_CTE}, {_ROWS},
fine AS (SELECT * FROM churn_zero WHERE NOT ({MALFORMED_LINE})),
{vocab_ctes("fine", CHURN.categorical)},
{indexed_cte("fine", CHURN.categorical)},
pred AS (SELECT *, CASE WHEN 1 / (1 + exp(-raw)) >= 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction
  FROM (SELECT *, {churn_raw_sql()} AS raw FROM indexed)),
bad AS (SELECT custkey, 'tenure: not a valid int: ''x''' AS error FROM churn WHERE {BAD}
  UNION ALL SELECT custkey, 'total_spent: missing' FROM churn WHERE {TEN}
  {" ".join(f"UNION ALL SELECT custkey, '{c}: missing' FROM churn WHERE {c} IS NULL" for c in CHURN.categorical)}),
issues AS (SELECT custkey, error FROM bad WHERE NOT ({MALFORMED_LINE})
  UNION ALL SELECT custkey, 'malformed line: ' || customerID FROM churn WHERE {MALFORMED_LINE})
SELECT row, 'scored' AS side, customerID AS id, prediction, CAST(NULL AS VARCHAR) AS error FROM pred JOIN numbered ON custkey = _c
WHERE custkey NOT IN (SELECT custkey FROM bad)
UNION ALL SELECT row, 'issue', NULL, NULL, error FROM issues JOIN numbered ON custkey = _c"""


@sql("scan_csv_inferred")
def _scan_csv_inferred() -> str:
    types = {"customerID": "int", "n_orders": "int", "avg_order": "double", "acctbal": "double"}
    named = ",".join(f"{c}:{types.get(c, 'string')}" for c in (*CHURN.required, CHURN.target))
    return f"""WITH {CHURN_CTE}
SELECT CAST(custkey AS INTEGER) AS customerID, segment, nation, region, top_priority, n_orders,
       CASE WHEN {BAD} THEN 'x' ELSE CAST(tenure AS VARCHAR) END AS tenure, avg_order,
       CASE WHEN {TEN} THEN NULL ELSE total_spent END AS total_spent, acctbal, churn, '{named}' AS types
FROM churn"""


# ---------------------------------------------------------------- ROC curves, trees
@sql("roc_points")
def _roc_points() -> str:
    return f"""WITH {rules_stacked_cte()},
d AS (SELECT model, raw AS s, sum(label) AS pos, sum(1 - label) AS neg FROM st GROUP BY model, raw),
r AS (SELECT *, row_number() OVER w AS rank, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, count(*) OVER (PARTITION BY model) AS n,
      sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS q
      FROM d WINDOW w AS (PARTITION BY model ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT model, (rank - 1) // greatest(1, n // 50) AS bin, max(s) AS s, max(tp) / max(p) AS tpr, max(fp) / max(q) AS fpr FROM r WHERE p > 0 AND q > 0 GROUP BY ALL)
SELECT model, bin + 1 AS point, round(s, 6) AS threshold, CAST(fpr AS DOUBLE) AS fpr, CAST(tpr AS DOUBLE) AS tpr FROM b
UNION ALL SELECT model, 0, NULL, 0.0, 0.0 FROM b GROUP BY model
UNION ALL SELECT model, max(bin) + 2, NULL, 1.0, 1.0 FROM b GROUP BY model"""


def _tree_sql(tree: tuple, leaf) -> str:
    if len(tree) == 2:
        return dbl(leaf(tree))
    feature, split, left, right = tree
    x = f"CAST({CHURN.numeric[feature]} AS DOUBLE)"
    test = f"{x} IN ({', '.join(dbl(v) for v in split)})" if isinstance(split, list) else f"{x} <= {dbl(split)}"
    return f"(CASE WHEN {test} THEN {_tree_sql(left, leaf)} ELSE {_tree_sql(right, leaf)} END)"


@sql("score_trees_fixed")
def _score_trees_fixed() -> str:
    votes = [" + ".join(_tree_sql(t, lambda x: x[1][c] / sum(x[1])) for t in FIXED_TREES) for c in (0, 1)]
    margin = " + ".join(f"{dbl(w)} * {_tree_sql(t, lambda x: x[0])}" for t, w in zip(FIXED_TREES, FIXED_WEIGHTS))
    return f"""WITH {CHURN_ZERO_CTE},
v AS (SELECT customerID, {votes[0]} AS v0, {votes[1]} AS v1, {margin} AS m FROM churn_zero)
SELECT customerID, round(v1 / (v0 + v1), 6) AS rf_p1, CASE WHEN v1 > v0 THEN 1.0 ELSE 0.0 END::DOUBLE AS rf_prediction,
  round(1 / (1 + exp(-2 * m)), 6) AS gbt_p1, CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS gbt_prediction FROM v"""
