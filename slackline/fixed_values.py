"""Lists and constants that results depend on, kept as plain text."""

# --- fixed values: account groups -------------------------------------------------
SEED = 42

CATEGORIES = {
    "Personalaufwand": [30],
    "Betrieblicher_Aufwand": [30, 31, 33, 35, 36, 37, 39],
    "Betrieblicher_Ertrag": [40, 41, 42, 43, 45, 46, 47, 49],
    "Finanz_Aufwand": [34],
    "Finanz_Ertrag": [44],
    "Ausserordentlicher_Aufwand": [38],
    "Ausserordentlicher_Ertrag": [48],
    "Investitionsausgaben": [50, 51, 52, 54, 55, 56, 57, 58],
    "Investitionseinnahmen": [60, 61, 62, 63, 64, 65, 66, 67, 68],
    "Finanzvermögen": [10],
    "Verwaltungsvermögen": [14],
    "Fremdkapital": [20],
    "Eigenkapital": [29],
    "Aufwand": [30, 31, 33, 34, 35, 36, 37, 38, 39],
    "Ertrag": [40, 41, 42, 43, 44, 45, 46, 47, 48, 49],
    "Alle": [
        10, 14, 20, 29,
        30, 31, 33, 34, 35, 36, 37, 38, 39,
        40, 41, 42, 43, 44, 45, 46, 47, 48, 49,
        50, 51, 52, 54, 55, 56, 57, 58,
        60, 61, 62, 63, 64, 65, 66, 67, 68,
    ],
}

# Balance-sheet accounts: a row without a budget is dropped.
BALANCE_ACCOUNTS = [10, 14, 20, 29]
PERSONNEL_ACCOUNT = 30

# --- fixed values: old chart of accounts -> new chart; a split is always even -----
CROSSWALK = {
    "1": ["1"],
    "2": ["2"],
    "3": ["3"],
    "4": ["4"],
    "5": ["5"],
    "6": ["6"],
    "30": ["30"],
    "31": ["31"],
    "32": ["34"],
    "33": ["33"],
    "34 - 37": ["34", "35", "36", "37"],
    "38": ["35"],
    "39": ["39"],
    "40": ["40"],
    "41 / 43": ["41", "43"],
    "44 - 47": ["44", "45", "46", "47"],
    "48": ["45"],
    "49": ["49"],
    "50": ["50"],
    "52": ["54"],
    "56 - 58": ["56", "57", "58"],
    "60 - 61": ["60", "61"],
    "62 - 67": ["62", "63", "64", "65", "66", "67"],
}

# --- fixed values: sheet layouts ---------------------------------------------------
# 0-based header row per layout; the row right after the header is not data.
HEADER_ROW = {"HRM1": 1, "HRM2_TO_2018": 1, "HRM2_FROM_2019": 4}
NEW_LAYOUT_YEAR = 2019

# Header labels of the reference-id, account and name columns.
REF_LABEL = "Referenz-ID"
ACCOUNT_LABEL = "HRM 2"
NAME_LABELS = {
    "HRM2_TO_2018": ["in 1000 Franken", "en 1000 frs."],
    "HRM2_FROM_2019": ["in 1 000 Franken", "en 1 000 frs."],
}
ZERO_LABEL = "0"

# Sheet names: standard before the region, or region before the standard.
SHEET_NAME = r"(HRM\d)[_ ]?KT_([A-Z]{2})|([A-Z]{2})[_ ](HRM\d)"

# Defaults for columns that old files lack.
DEFAULT_REF_ID = "HRM1"
DEFAULT_NAME = "Missing Name"

# --- fixed values: the budgeting experiment ---------------------------------------
FORECAST = 138849
ARM_AI = "FL_74"
ARM_NO_AI = "FL_76"
CONSENT = "Yes, I consent to participate"
# An answer passes the manipulation check when it fits its arm.
CHECK_RULES = {ARM_AI: "Yes", ARM_NO_AI: "No"}
FUNNEL_STEPS = [
    "Total Survey Participants",
    "Passed Knowledge Check",
    "Completed Responses",
    "Manipulation Check Passed",
]
AGE_EDGES = [0, 24, 35, 51, 66]
AGE_LABELS = ["18–24 years", "25–34 years", "35–50 years", "51–65 years", "65+ years"]
EXPERIENCE_LABELS = ["< 1 year", "1–5 years", "6–10 years", "> 10 years"]
SEX_LABELS = ["Male", "Female", "Other"]
SEX_OTHER = ["Prefer not to say", "Non-binary", "Other"]

# --- fixed values: word list columns ----------------------------------------------
SENTIMENTS = [
    "negative",
    "positive",
    "uncertainty",
    "litigious",
    "strong_modal",
    "weak_modal",
    "constraining",
]

# --- fixed values: model search ----------------------------------------------------
# (parameter, kind, low, high)
SEARCH_SPACES = {
    "xgboost": [
        ("learning_rate", "uniform", 0.01, 0.3),
        ("colsample", "uniform", 0.1, 1.0),
        ("max_depth", "int", 3, 12),
        ("subsample", "uniform", 0.5, 1.0),
        ("trees", "int", 100, 1000),
    ],
    "catboost": [
        ("learning_rate", "uniform", 0.01, 0.3),
        ("colsample", "log", 0.01, 0.2),
        ("max_depth", "int", 1, 12),
        ("subsample", "log", 0.1, 1.0),
        ("trees", "int", 100, 1500),
    ],
    "hgb": [
        ("learning_rate", "log", 1e-3, 1e-1),
        ("trees", "int", 100, 1000),
        ("max_depth", "int", 3, 12),
        ("min_leaf", "int", 4, 200),
    ],
}
N_TRIALS = 100
# Names of the parameter files -> names used here.
PARAMETER_NAMES = {
    "n_estimators": "trees",
    "iterations": "trees",
    "max_iter": "trees",
    "eta": "learning_rate",
    "depth": "max_depth",
    "colsample_bytree": "colsample",
    "colsample_bylevel": "colsample",
    "min_samples_leaf": "min_leaf",
    "bootstrap_type": "bootstrap",
}
EARLY_STOPPING_ROUNDS = 100
