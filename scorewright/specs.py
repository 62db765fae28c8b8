"""Column contracts and parameter defaults.

The Telco lists below are fixed values: they must equal what the original jobs use so that a
Telco CSV trained or scored here has the same features, in the same order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (Telco churn contract) -------------------------------------------------
TELCO_REQUIRED_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents",
    "tenure", "PhoneService", "MultipleLines", "InternetService",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges",
]
TELCO_CATEGORICAL = [
    "gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
    "PaperlessBilling", "PaymentMethod",
]
TELCO_NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
TELCO_INT_COLUMNS = ["SeniorCitizen", "tenure"]
TELCO_DOUBLE_COLUMNS = ["MonthlyCharges", "TotalCharges"]
TELCO_SCORING_DEFAULTS = {"SeniorCitizen": 0, "tenure": 0, "MonthlyCharges": 0.0, "TotalCharges": 0.0}
WHOLESALE_COLUMNS = ["Fresh", "Milk", "Grocery", "Frozen", "Detergents_Paper", "Delicassen"]
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".bmp", ".gif"]
PREDS_CSV_HEADER = ["filename", "label", "confidence"]
ERROR_LABEL = "ERROR"
SPLIT_SEED = 42
TRAIN_FRACTION = 0.8
# ---------------------------------------------------------------------------------------------

# --- fixed values (model parameters of the original jobs) ---------------------------------
RF_PARAMS = {"numTrees": 100, "maxDepth": 8}
GBT_PARAMS = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1}
LR_CHURN_PARAMS = {"maxIter": 50}
LR_EMBEDDING_PARAMS = {"maxIter": 50}
LR_WEIGHTED_PARAMS = {"maxIter": 50, "regParam": 0.01, "elasticNetParam": 0.0}
KMEANS_PARAMS = {"k": 5, "seed": 42}
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """Roles of the columns of a customer table."""

    id_col: str
    categorical: list[str]
    numeric: list[str]
    int_columns: list[str] = field(default_factory=list)
    double_columns: list[str] = field(default_factory=list)
    target: str | None = None
    positive: str = "Yes"
    blank_column: str | None = None          # column whose " " means "missing"
    defaults: dict = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [self.id_col, *self.categorical, *self.numeric]


TELCO = TableSpec(
    id_col="customerID",
    categorical=TELCO_CATEGORICAL,
    numeric=TELCO_NUMERIC,
    int_columns=TELCO_INT_COLUMNS,
    double_columns=TELCO_DOUBLE_COLUMNS,
    target="Churn",
    blank_column="TotalCharges",
    defaults=TELCO_SCORING_DEFAULTS,
)

# Stand-in churn table built from customer/orders/nation/region (see sources/tables.py).
CHURN = TableSpec(
    id_col="customerID",
    categorical=["segment", "nation", "region", "top_priority"],
    numeric=["n_orders", "tenure", "avg_order", "total_spent", "acctbal"],
    int_columns=["n_orders", "tenure"],
    double_columns=["avg_order", "total_spent", "acctbal"],
    target="churn",
    blank_column="total_spent",
    defaults={"n_orders": 0, "tenure": 0, "avg_order": 0.0, "total_spent": 0.0, "acctbal": 0.0},
)

WHOLESALE_STANDIN_COLUMNS = ["economy", "large", "medium", "promo", "small", "standard"]
