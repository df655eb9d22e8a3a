"""Fixed values that must equal the original scripts byte for byte.

Fixed values: status texts, flags and thresholds, listed as they appear in
the analysis they belong to. Emoji and padding spaces are part of the text.
"""

# ---- fixed values: data-quality scorecard (profiling) ----------------------
QUALITY_PASS = "PASS — Data quality acceptable for reconciliation"
QUALITY_FAIL = "FAIL — Critical nulls detected. Investigate before proceeding."
QUALITY_WARNING = "WARNING — Duplicates detected. Review before reconciliation."
QUALITY_REVIEW = "REVIEW REQUIRED"

# ---- fixed values: revenue sign buckets (profiling) ------------------------
SIGN_POSITIVE = "Positive Revenue"
SIGN_ZERO = "Zero Revenue"
SIGN_NEGATIVE = "Negative / Credit"
SIGN_NULL = "NULL"

# ---- fixed values: deduplication -------------------------------------------
DEDUP_KEEP = "KEEP"
DEDUP_REMOVE = "REMOVE"
REMOVAL_REASON = "REMOVED AS DUPLICATE"
REMOVED_BY_PROCESS = "Revenue Reconciliation Project"
STAGE_BEFORE = "Before dedup"
STAGE_AFTER = "After dedup"
PREFERRED_SOURCE_SYSTEM = "SYSTEM_A"

# ---- fixed values: three-way match -----------------------------------------
ACCOUNT_REVENUE = "REVENUE"
MISSING_IN_GL = "MISSING_IN_GL"
MISSING_IN_BANK = "MISSING_IN_BANK"
MULTI_SYSTEM_VARIANCE = "MULTI_SYSTEM_VARIANCE"
GL_VARIANCE = "GL_VARIANCE"
BANK_VARIANCE = "BANK_VARIANCE"
TIMING_DIFFERENCE = "TIMING_DIFFERENCE"
MATCHED = "MATCHED"
REVIEW_REQUIRED = "REVIEW_REQUIRED"
# sort rank of each status in the detail report, 1 first, anything else 8
STATUS_ORDER = (
    MULTI_SYSTEM_VARIANCE,
    GL_VARIANCE,
    BANK_VARIANCE,
    MISSING_IN_GL,
    MISSING_IN_BANK,
    TIMING_DIFFERENCE,
    MATCHED,
)
TOLERANCE = "0.01"
TIMING_DAYS = 5
PRIORITY_HIGH = "HIGH PRIORITY"
PRIORITY_MEDIUM = "MEDIUM PRIORITY"
PRIORITY_LOW = "LOW PRIORITY"
PRIORITY_NONE = ""
PRIORITY_HIGH_ABOVE = 1000
PRIORITY_MEDIUM_ABOVE = 100

# ---- fixed values: anomaly detection ---------------------------------------
Z_THRESHOLD = 2
IQR_K = 1.5
SEVERITY_CRITICAL = "🔴 CRITICAL — >4 std devs"
SEVERITY_HIGH = "🟠 HIGH     — >3 std devs"
SEVERITY_MEDIUM = "🟡 MEDIUM   — >2 std devs"
SEVERITY_NORMAL = "🟢 NORMAL"
DIRECTION_ABOVE = "ABOVE AVERAGE"
DIRECTION_BELOW = "BELOW AVERAGE"
IQR_HIGH = "🔴 HIGH OUTLIER"
IQR_LOW = "🔵 LOW OUTLIER"
IQR_WITHIN = "🟢 WITHIN RANGE"
METHOD_Z = "Z_SCORE"
METHOD_IQR = "IQR"
BOTH_METHODS = "⚠️ FLAGGED BY BOTH METHODS — HIGHEST PRIORITY"

# ---- fixed values: deferred revenue ----------------------------------------
DEFERRED = "DEFERRED"
FULLY_RECOGNISED = "FULLY_RECOGNISED"
MATERIAL = "🔴 MATERIAL — >50% deferred"
REVIEW = "🟡 REVIEW   — >10% deferred"
IMMATERIAL = "🟢 IMMATERIAL"
MATERIAL_ABOVE = 0.5
REVIEW_ABOVE = 0.1

# ---- fixed values: executive scorecard -------------------------------------
RAG_GREEN = "GREEN"
RAG_AMBER = "AMBER"
RAG_RED = "RED"
RAG_GREEN_AT = 99.0
RAG_AMBER_AT = 95.0
TOP_HIGH = "HIGH"
TOP_MEDIUM = "MEDIUM"
TOP_LOW = "LOW"
TOP_HIGH_ABOVE = 10000
TOP_MEDIUM_ABOVE = 1000
TOP_N = 10
CURRENCY = "£"
SUMMARY_DATE_FORMAT = "dd MMM yyyy"

# ---- fixed values: row-count report ----------------------------------------
COUNTED_TABLES = ("sales_transactions", "gl_postings", "bank_settlements")
