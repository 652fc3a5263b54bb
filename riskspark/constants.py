"""Fixed values that must equal the original workflow's for equal results.

Fixed values (keep as written):
  scorecard:      base score 600, base odds 50 (good:bad), 20 points to double the odds
  clipping:       probability clipped to [0.001, 0.999]
  risk bands:     below 450 "Very High Risk", below 550 "High Risk",
                  below 650 "Medium Risk", below 750 "Low Risk", else "Very Low Risk";
                  a missing score is "Unknown"
  sentinel:       365243 in every column whose name contains "DAYS_"
  leakage audit:  folded AUC above 0.99 flags a column; at least 100 non-null values
  cardinality:    fewer than 10 distinct values is low cardinality, 10 or more is high
  one-hot:        missing category text "missing"
  split:          test share 0.2, seed 42; 5 folds
  search:         50 trials, 5 folds, early stop after 50 rounds
  PSI:            10 bins, shares floored at 0.0001, below 0.1 "Stable",
                  below 0.25 "Moderate Shift", else "Significant Shift"
  monotonicity:   tolerance 0.005 on the decile default rate
  histograms:     50 bins
  explanation:    5000 sampled test rows, seed 42
  reports:        top 50 missing columns, top 20 features (plots), top 15 (dashboard),
                  15 waterfall rows (reports), 12 (dashboard), first 10 ids
  outcome text:   1 "Defaulted", 0 "Repaid", absent "Unknown"
  age:            abs(days) / 365.25, one decimal
  CSV sources:    header row, column types inferred (from every row here)
"""

BASE_SCORE = 600
BASE_ODDS = 50
PDO = 20
P_MIN = 0.001
P_MAX = 0.999

BAND_EDGES = (450, 550, 650, 750)
BAND_NAMES = ("Very High Risk", "High Risk", "Medium Risk", "Low Risk", "Very Low Risk")
BAND_UNKNOWN = "Unknown"

SENTINEL_VALUE = 365243
SENTINEL_NAME_PART = "DAYS_"

LEAKAGE_AUC = 0.99
LEAKAGE_MIN_VALUES = 100

CARDINALITY_CUT = 10
MISSING_CATEGORY = "missing"

RANDOM_STATE = 42
TEST_SIZE = 0.2
N_FOLDS = 5
N_TRIALS = 50
EARLY_STOPPING_ROUNDS = 50

PSI_BINS = 10
PSI_FLOOR = 0.0001
PSI_STABLE = 0.1
PSI_MODERATE = 0.25
PSI_VERDICTS = ("Stable", "Moderate Shift", "Significant Shift")

MONOTONE_TOLERANCE = 0.005
HIST_BINS = 50

SHAP_SAMPLE_SIZE = 5000

TOP_MISSING = 50
TOP_FEATURES_PLOT = 20
TOP_FEATURES_DASHBOARD = 15
WATERFALL_REPORT = 15
WATERFALL_DASHBOARD = 12
FIRST_IDS = 10

OUTCOME_DEFAULTED = "Defaulted"
OUTCOME_REPAID = "Repaid"
OUTCOME_UNKNOWN = "Unknown"
DAYS_PER_YEAR = 365.25

KEY = "SK_ID_CURR"
LABEL = "TARGET"
