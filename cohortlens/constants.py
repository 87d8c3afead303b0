"""Fixed domain values.

These must equal the reference's values for the results to agree; they are
stated here once, in natural order, and every operator takes them as default
parameters so the domain is a default and not a restriction.
"""

# --- fixed values: cohort definition -------------------------------------
STUDY_TYPE_INTERVENTIONAL = "INTERVENTIONAL"
COHORT_PHASES = ("PHASE2", "PHASE2/PHASE3", "PHASE3")
COHORT_STATUSES = ("COMPLETED", "TERMINATED")
STATUS_COMPLETED = "COMPLETED"
STATUS_TERMINATED = "TERMINATED"

# --- fixed values: phase code (phase -> number); unlisted -> NULL ----------
PHASE_CODES = {"PHASE2": 2.0, "PHASE2/PHASE3": 2.5, "PHASE3": 3.0}

# --- fixed values: lead-sponsor marker, enrollment and outcome kinds -------
LEAD = "lead"
ENROLLMENT_ACTUAL = "ACTUAL"
OUTCOME_PRIMARY = "PRIMARY"

# --- fixed values: sponsor class -> ordinal; unknown / NULL -> 4 ----------
AGENCY_CLASS_CODES = {
    "INDUSTRY": 0,
    "NIH": 1,
    "OTHER_GOV": 2,
    "NETWORK": 3,
    "OTHER": 4,
    "FED": 5,
    "INDIV": 6,
    "UNKNOWN": 7,
}
AGENCY_CLASS_DEFAULT = 4

# --- fixed values: duration -----------------------------------------------
DAYS_PER_MONTH = 30.44

# --- fixed values: risk bands, right-closed (0, .25], (.25, .5], (.5, .75], (.75, 1]
BAND_EDGES = (0.0, 0.25, 0.50, 0.75, 1.0)
BAND_LABELS = ("Low", "Medium", "High", "Very High")
BAND_LABELS_LONG = ("Low (0-25%)", "Medium (25-50%)", "High (50-75%)", "Very High (75-100%)")

# --- fixed values: high-risk flag score ------------------------------------
RISK_FLAG_TERMINATED_WEIGHT = 3
RISK_FLAG_NO_RESULTS_WEIGHT = 2
RISK_FLAG_WITHDRAWAL_THRESHOLD = 100

# --- fixed values: report sizes ---------------------------------------------
TOP_WITHDRAWAL_REASONS = 15
TOP_HIGH_RISK = 50
SPONSOR_MIN_TRIALS = 50
SCATTER_SAMPLE_SIZE = 5000
SAMPLE_SEED = 42
TEST_FRACTION = 0.2

# --- fixed values: plot ranges ----------------------------------------------
ENROLLMENT_HIST_MAX = 1000
ENROLLMENT_HIST_BINS = 50
DURATION_SCATTER_MAX = 300
RISK_HIST_BINS = 50
DASH_SCORE_BIN_WIDTH = 0.05

# --- fixed values: pandas' default missing-value tokens for text input ----
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: model features and target, in the reference's order ---
FEATURES = (
    "phase_numeric",
    "log_enrollment",
    "is_actual_enrollment",
    "duration_months",
    "number_of_arms",
    "sponsor_encoded",
    "log_site_count",
    "is_multinational",
    "log_withdrawals",
    "num_primary_outcomes",
    "has_outcomes_posted",
)
TARGET = "is_terminated"
PHASE_NUMERIC_DEFAULT = 2.0
SITE_COUNT_DEFAULT = 1

# --- fixed values: model hyper-parameters (library defaults) --------------
LR_MAX_ITER = 1000
RF_NUM_TREES = 200
RF_MAX_DEPTH = 8
RF_MIN_LEAF = 20
GBT_ROUNDS = 300
GBT_MAX_DEPTH = 5
GBT_STEP = 0.05
GBT_SUBSAMPLE = 0.8
GBT_COLSAMPLE = 0.8
MODEL_SEED = 42
