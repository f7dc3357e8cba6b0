"""Column roles, field rules and fixed values of the customer-churn problem."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns of a table are categories, numbers, the label and the key."""

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    label: str
    key: str | None = None
    positive: str = "Yes"
    negative: str = "No"

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric

    def vector_inputs(self) -> list[str]:
        """Names going into the assembler, in order: encoded categories, then numbers."""
        return [f"{c}_vec" for c in self.categorical] + list(self.numeric)


def categorical_columns(columns: list[str], spec: FeatureSpec) -> list[str]:
    """Columns that are neither numeric nor the label, in table order."""
    return [c for c in columns if c not in spec.numeric and c != spec.label]


@dataclass(frozen=True)
class Field:
    """One request field: its type and what values are accepted."""

    name: str
    type: str = "string"
    allowed: tuple | None = None
    ge: float | None = None
    le: float | None = None
    gt: float | None = None
    required: bool = True


# --- Fixed values: request fields and their domains -----------------------------------------
_YES_NO = ("Yes", "No")
_ADD_ON = ("Yes", "No", "No internet service")

CUSTOMER_FIELDS: tuple[Field, ...] = (
    Field("gender", allowed=("Male", "Female")),
    Field("SeniorCitizen", "int", allowed=(0, 1)),
    Field("Partner", allowed=_YES_NO),
    Field("Dependents", allowed=_YES_NO),
    Field("tenure", "int", ge=0, le=72),
    Field("PhoneService", allowed=_YES_NO),
    Field("MultipleLines", allowed=("Yes", "No", "No phone service")),
    Field("InternetService", allowed=("DSL", "Fiber optic", "No")),
    Field("OnlineSecurity", allowed=_ADD_ON),
    Field("OnlineBackup", allowed=_ADD_ON),
    Field("DeviceProtection", allowed=_ADD_ON),
    Field("TechSupport", allowed=_ADD_ON),
    Field("StreamingTV", allowed=_ADD_ON),
    Field("StreamingMovies", allowed=_ADD_ON),
    Field("Contract", allowed=("Month-to-month", "One year", "Two year")),
    Field("PaperlessBilling", allowed=_YES_NO),
    Field("PaymentMethod", allowed=(
        "Electronic check", "Mailed check",
        "Bank transfer (automatic)", "Credit card (automatic)",
    )),
    Field("MonthlyCharges", "double", gt=0),
    Field("TotalCharges", "double", ge=0),
)

# --- Fixed values: column roles of the customer table -----------------------------------------
CUSTOMER = FeatureSpec(
    categorical=(
        "gender", "Partner", "Dependents", "PhoneService", "MultipleLines",
        "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
        "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
        "PaperlessBilling", "PaymentMethod",
    ),
    numeric=("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"),
    label="Churn",
    key="customerID",
)

# --- Fixed values: monitoring -----------------------------------------------------------------
SCORE_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
BATCH_BOUNDS = (1, 5, 10, 25, 50, 100, 250, 500, 1000)
LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0,
                  4.5, 5.0, 7.5, 10.0, 30.0, 60.0)
LEVELS = ("high", "medium", "low")
MAX_BATCH = 1000
GATE_THRESHOLD = 0.80
RUN_METRICS = (
    "auc_roc", "accuracy", "precision", "recall", "f1_score", "training_duration_seconds",
)
RUN_PARAMS = (
    "algorithm", "num_cv_folds", "train_test_split", "feature_count",
    "training_rows", "param_grid_size", "param_grid",
)

_SQL_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType()}


def request_schema(fields: tuple[Field, ...] = CUSTOMER_FIELDS, text: bool = False) -> T.StructType:
    """Schema of a request row; with ``text`` every field is a string, to be checked later."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if text else _SQL_TYPES[f.type]) for f in fields
    ])


def raw_customer_schema() -> T.StructType:
    """Schema of the raw customer file: id first, total as text, label last."""
    cols = [T.StructField("customerID", T.StringType())]
    for f in CUSTOMER_FIELDS:
        kind = T.StringType() if f.name == "TotalCharges" else _SQL_TYPES[f.type]
        cols.append(T.StructField(f.name, kind))
    return T.StructType(cols + [T.StructField("Churn", T.StringType())])
