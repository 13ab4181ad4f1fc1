"""Texts, formats and sets that results have to carry exactly.

Nothing in this file is logic.  Changing a value changes results.
"""

# Characters counted as whitespace (the Unicode whitespace set).
WHITESPACE_NARROW = r"\x09\x0A\x0B\x0C\x0D\x1C\x1D\x1E\x1F\x85\xA0"
WHITESPACE_WIDE = (
    r"\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# A query needs one of these characters.
ALNUM_PATTERN = "[A-Za-z0-9]"

# Column defaults and markers.
UNKNOWN_USER = "unknown"
UNKNOWN_LANGUAGE = "unknown"
DEFAULT_LANGUAGE = "en"
NOISE_LABEL = -1
NOISE_SUFFIX = "_-1"

# Names of the filters, in the order in which they apply.
DROP_LENGTH = "length"
DROP_BLANK = "blank"
DROP_NO_ALNUM = "no_alnum"
DROP_LANGUAGE = "language"
DROP_TOPICS = "topics"
DROP_DUPLICATES = "duplicates"

# Wording of the reasons for which a cluster is rejected.
REASON_SIZE = "too few queries: %d (min %s)"
REASON_COHESION = "low avg similarity: %.4f (min %s)"
REASON_USERS = "not enough unique users: %d (min %s)"

# Queries used when a text generator gives nothing.
FALLBACK_WITH_TOPIC = "What is %s?"
FALLBACK_WITHOUT_TOPIC = "How to research this topic?"
PROMPT_EXAMPLES = 10

# Lines of the text report.
REPORT_RULE = "=" * 60
REPORT_TITLE = "CLUSTER ANALYSIS REPORT"
REPORT_GENERATED = "Generated: %s"
REPORT_CANDIDATES_TITLE = "=== SEO CANDIDATE CLUSTERS ==="
REPORT_CANDIDATE = "\U0001F4C8 SEO Candidate: %s"
REPORT_CANDIDATE_LINES = (
    "   Topic: %s",
    "   Queries: %s",
    "   Avg Similarity: %s",
    "   Unique Users: %s",
    "   Representative: %s",
)
REPORT_CANDIDATES_TOTAL = "Total SEO Candidates: %s"
REPORT_CLUSTERS_TITLE = "ALL CLUSTERS"
REPORT_CLUSTER = "=== Cluster %s ==="
REPORT_CLUSTER_LINES = (
    "Number of queries: %s",
    "Average similarity: %s",
    "Unique users: %s",
    "Representative: %s",
)
REPORT_CLUSTERS_TOTAL = "Total Valid Clusters: %s"
