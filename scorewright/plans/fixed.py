"""Fixed scorers: linear rules with known coefficients, so every metric and scoring query has an
exact SQL oracle without training anything.  The same Python lists feed the Spark plans and the
generated oracle SQL."""

from __future__ import annotations

# --- fixed values ----------------------------------------------------------------------------
# churn stand-in, numeric block in CHURN.numeric order: n_orders, tenure, avg_order, total_spent, acctbal
CHURN_NUMERIC_WEIGHTS = [-0.35, -0.03, 2e-06, -1e-07, 0.0001]
CHURN_INTERCEPT = 1.5
# a second and third rule for the stacked model comparison
CHURN_ALT_RULES = {
    "rule_a": ([-0.35, -0.03, 2e-06, -1e-07, 0.0001], 1.5),
    "rule_b": ([-0.5, 0.0, 0.0, 0.0, 0.0], 2.0),
    "rule_c": ([0.0, -0.05, 0.0, 0.0, 0.0002], 0.25),
}
EMBED_INTERCEPT = 0.1
# -----------------------------------------------------------------------------------------------


def onehot_weight(j: int) -> float:
    """Weight of feature slot ``j`` of a one-hot block: a rule, not a table."""
    return (((j * 37) % 19) - 9) / 20


def churn_weights(size: int, numeric=CHURN_NUMERIC_WEIGHTS) -> list[float]:
    return [*numeric, *[onehot_weight(j) for j in range(len(numeric), size)]]


def embed_weight(j: int) -> float:
    return (((j * 7) % 11) - 5) / 10


def embed_weights(dim: int) -> list[float]:
    return [embed_weight(j) for j in range(dim)]


def wholesale_centres(k: int, dim: int) -> list[list[float]]:
    """k fixed centres in standardised space."""
    return [[(((i + 1) * (j + 2)) % 5 - 2) * 0.5 for j in range(dim)] for i in range(k)]

# --- fixed values: file-name extensions used for the derived image paths (mixed case, one non-image)
NAME_EXTENSIONS = [".JPG", ".jpeg", ".Png", ".bmp", ".GIF", ".txt"]


# --- fixed values: three trees over CHURN.numeric ------------------------------------------------------------
# split: (feature, threshold or categories that go left, left, right); leaf: (value, [weight of class 0, of class 1])
FIXED_TREES = [
    (0, 9.5, (1, 90.0, (0.4, [3.0, 7.0]), (-0.2, [8.0, 2.0])), (4, 2500.0, (-0.5, [9.0, 1.0]), (-0.9, [19.0, 1.0]))),
    (2, 150000.0, (0.1, [5.0, 5.0]), (3, 1500000.0, (0.6, [2.0, 6.0]), (1, 92.0, (-0.3, [4.0, 1.0]), (0.2, [3.0, 4.0])))),
    (0, [7.0, 8.0, 10.0, 13.0], (0.25, [1.0, 2.0]), (-0.35, [5.0, 2.0])),
]
FIXED_WEIGHTS = [1.0, 0.1, 0.1]          # of the boosted form; the voting one weighs all trees alike
# --------------------------------------------------------------------------------------------------------------


def tree_rows(tree: tuple) -> list[tuple]:
    """A nested tree as node rows (node, feature, n_categories, split, left, right, prediction, stats), root first."""
    rows: list = []

    def add(t: tuple) -> int:
        at = len(rows)
        rows.append(None)
        if len(t) == 2:
            rows[at] = (at, -1, -1, [], -1, -1, t[0], t[1])
        else:
            feature, split, left, right = t
            cats = isinstance(split, list)
            rows[at] = (at, feature, 20 if cats else -1, split if cats else [split], add(left), add(right), 0.0, [0.0, 0.0])
        return at

    add(tree)
    return rows


def fixed_forest(spark, kind: str):
    from scorewright.operators.trees import Forest

    rows = [(k, w, *r) for k, (t, w) in enumerate(zip(FIXED_TREES, FIXED_WEIGHTS)) for r in tree_rows(t)]
    nodes = spark.createDataFrame(rows, "tree int, weight double, node int, feature int, n_categories int, split array<double>, "
                                        "left int, right int, prediction double, stats array<double>")
    return Forest(nodes, kind, 2, 3)
