"""Fixed values that must equal the reference's for identical results."""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference exactly)
# ---------------------------------------------------------------------------
CHANGE_WINDOWS = [1, 5, 10, 15, 30, 45, 90]
ROLLING_WINDOWS = [5, 10, 15, 30, 45, 90]
PRICE_COLS = ["open", "close", "high", "low"]
ORDER_FLOW_WINDOWS = [5, 10, 14, 20, 30]
INTRADAY_COLS = ["intraday_range", "close_minus_open", "high_minus_close", "close_minus_low"]

SUPPORTED_COUNTRIES = ["United States", "Canada"]
SUPPORTED_CURRENCIES = ["USD", "CAD"]

MARKET_CAP_BINS = [0.0, 300e6, 2e9, 10e9, 200e9, float("inf")]
MARKET_CAP_LABELS = ["micro", "small", "mid", "large", "mega"]

MIN_TRADING_DAYS = 45
MIN_FEATURE_BARS = 5
MIN_WINDOW_ROWS = 10

DEFAULT_LOOKBACK_BARS = 90
DEFAULT_BUFFER_DAYS = 5
TP_MARGIN_DAYS = 30
TN_MARGIN_DAYS = 40

TICKER_PATTERNS = [
    r'\((?:ticker|symbol|trading\s+symbol):\s*([A-Z]{1,5})\)',
    r'(?:ticker|trading)\s+symbol[^a-zA-Z]{1,10}([A-Z]{1,5})\b',
    r'\btraded\s+(?:on|under|as)\s+["\']?([A-Z]{1,5})["\']?',
    r'\bstock\s+symbol\s+["\']?([A-Z]{1,5})["\']?',
]

TICKER_STOPWORDS = [
    "THE", "AND", "FOR", "SEC", "LLC", "INC", "LTD", "USA", "USD", "NYSE",
    "OTC", "CEO", "CFO", "NOT", "BUT", "ALL", "ARE", "WAS", "ITS", "HIS",
    "HER", "WHO", "ACT", "ANY", "NEW", "OLD", "TWO", "ONE", "TEN",
]

DOCUMENT_BASE_URL = "https://www.sec.gov"

# symbols of securities that are not common stock (warrants, rights, preferred and similar)
SYMBOL_BAD_CHARS = r"[.+$^~%]"
SYMBOL_BAD_SUFFIXES = ["W", "R", "P"]
SYMBOL_MAX_LENGTH = 5

METRIC_COLS = [
    "threshold", "precision", "recall", "f1", "specificity", "tp", "fp", "tn", "fn",
    "roc_auc", "pr_auc", "cost", "cost_per_case", "n_positive", "n_negative", "n_total",
]

DEFAULT_FP_COST = 1.0
DEFAULT_FN_COST = 5.0
SUMMARY_THRESHOLDS = 19          # linspace(0.05, 0.95, 19)
OPTIMISER_THRESHOLDS = 99        # linspace(0.01, 0.99, 99)

TREE_MAX_DEPTH = 4
TREE_MIN_LEAF = 2
FOREST_TREES = 100
FOREST_MAX_SAMPLES = 256
TN_TP_RATIO = 5
MATCH_BINS = 5
RANDOM_STATE = 42
DEFAULT_MATCH_METHOD = "distance_ranked"
# ---------------------------------------------------------------------------


def min_periods(window: int) -> int:
    """Rolling min-periods rule used by mean/std/CMF/MFI."""
    return max(2, window // 3)
