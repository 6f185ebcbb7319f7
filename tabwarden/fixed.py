"""Thresholds, tokens, formats and grids that results depend on."""

# --- fixed values -----------------------------------------------------------
SEED = 42
SPLIT_WEIGHTS = {"train": 70, "validation": 15, "test": 15}
N_FOLDS = 5

PSI_THRESHOLD = 0.2
MEAN_SHIFT_THRESHOLD = 0.10
PSI_FLOOR = 1e-4
WINDOW_DAYS = 7
COOLDOWN_DAYS = 1

DECISION_THRESHOLD = 0.5
RECALL_TOLERANCE = 0.005
MIN_RECALL_GAIN = 0.01

QUANTILES = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}

TRAIN_NULL_TOKENS = ("na",)
SCORE_NULL_TOKENS = ("na", "", " ")
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
    "None", "n/a", "nan", "null",
)

NULL_REASON = "Column '{column}' contains null/missing values."
MIN_REASON = "Column '{column}' value falls below minimum ({bound})."
MAX_REASON = "Column '{column}' value exceeds maximum ({bound})."
MALFORMED_REASON = "Malformed line: "
ALLOWED_REASON = "Column '{column}' value is not an allowed category."

MISSING_REQUIRED = "Missing required column"
INVALID_DTYPE = "Invalid dtype '{found}', expected semantic type '{expected}'"
NULLS_PRESENT = "Null values present in non-nullable column"
UNEXPECTED_COLUMN = "Unexpected column not defined in reference schema"

UNLABELLED = "Inference_Unlabelled"
TRIGGER_REASON = "Data Drift Detected"
NO_IMPORTANCE = "Model type does not support native feature importance extraction."

PARAMETER_GRIDS = {
    "logistic_regression": {
        "C": [0.01, 0.1, 1.0, 10.0],
        "penalty": ["l1", "l2"],
        "max_iter": [100, 300, 500],
    },
    "random_forest": {
        "n_estimators": [100, 300, 500],
        "max_depth": [None, 10, 20, 30],
        "min_samples_leaf": [1, 2, 4],
        "bootstrap": [True, False],
    },
    "gradient_boosting": {
        "n_estimators": [100, 300],
        "learning_rate": [0.01, 0.05, 0.1],
        "max_depth": [3, 5],
        "subsample": [0.8, 1.0],
    },
}
# -----------------------------------------------------------------------------
