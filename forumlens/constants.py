"""Fixed values.

These must equal the reference's for the same results: text patterns,
feature widths, estimator settings and line filters.  They are stated here
once, as plain values, and imported by the code that uses them.
"""

# ---- fixed values: text patterns ---------------------------------------------
TAG_SEPARATOR_PATTERN = "><"          # replaced by one space
TAG_BRACKET_PATTERN = "<|>"           # then removed
MARKUP_PATTERN = r"<\S+>"             # replaced by one space (greedy)
NON_WORD_PATTERN = r"\W"              # replaced by one space
# (between the two: newline -> space, then runs of spaces -> one space)

# ---- fixed values: XML dump line filters ---------------------------------------
XML_PROLOG_PREFIX = "<?xml version="
POSTS_WRAPPER = "posts"               # "<posts>", "</posts>"
TAGS_WRAPPER = "tags"                 # "<tags>", "</tags>"

# ---- fixed values: hashed term frequencies -------------------------------------
NUM_FEATURES = 50_000                 # per-tag training and scoring
PIPELINE_NUM_FEATURES = 64_000        # one-tag pipeline program

# ---- fixed values: estimators ----------------------------------------------------
PIPELINE_LR_MAX_ITER = 30
PIPELINE_LR_REG_PARAM = 0.02
LBFGS_MAX_ITER = 100
LBFGS_REG_PARAM = 0.0
LBFGS_FIT_INTERCEPT = False
LBFGS_THRESHOLD = 0.5
LBFGS_TOL = 1e-4                      # the RDD-API L-BFGS default convergence tolerance
SVM_MAX_ITER = 30
SVM_REG_PARAM = 0.01
SVM_FIT_INTERCEPT = False
NB_SMOOTHING = 1.0

# ---- fixed values: splits and samples ----------------------------------------------
HOLDOUT_WEIGHTS = (0.7, 0.3)
CLASS_SAMPLE_FRACTION = 0.9

# ---- fixed values: mining and clustering -------------------------------------------
FP_MIN_SUPPORT = 0.01
FP_MIN_CONFIDENCE = 0.8
PIC_K = 3
PIC_MAX_ITER = 10

# one dialect for writing and reading, under which every string and null
# comes back as it was
USER_TAG_CSV = {"header": "false", "nullValue": "\\N", "emptyValue": "", "escape": '"', "quoteAll": "true",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
