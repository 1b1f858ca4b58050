"""Mappings, thresholds and rate tables the results depend on.

Everything here is business data that must equal the documented rules; the
operators read it and hold no numbers of their own.
"""

# --- cleaning and features (fixed values) -----------------------------------

STATE_ABBREVIATIONS = {
    "new york": "NY",
    "california": "CA",
    "illinois": "IL",
    "texas": "TX",
    "arizona": "AZ",
    "pennsylvania": "PA",
    "washington": "WA",
    "colorado": "CO",
    "oregon": "OR",
    "florida": "FL",
    "georgia": "GA",
    "massachusetts": "MA",
}

# (shape, pattern) tried in this order; the first that fits the whole string
# wins. The shape is checked first because a failing parse is dear.
DATE_PATTERNS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d'T'H:m:s"),
)

GUEST_CUSTOMER_ID = -1
GUEST_EMAIL = "guest@unknown.com"
UNKNOWN_CHANNEL = "unknown"

# (older than N days, status), checked in order. An age of 0 days or less
# matches no rule and stays null.
STATUS_BY_AGE = ((30, "delivered"), (7, "shipped"), (0, "processing"))

SEASON_OF_MONTH = {
    1: "winter", 2: "winter", 3: "spring", 4: "spring", 5: "spring", 6: "summer",
    7: "summer", 8: "summer", 9: "fall", 10: "fall", 11: "fall", 12: "winter",
}
DISCOUNT_FACTOR = 0.9
VIP_MIN_ORDERS = 5
RETURN_RATE_BASELINE = 0.10

# --- returns (fixed values) -------------------------------------------------

RETURN_WINDOW_DAYS = 30
EXTENDED_WINDOW_DAYS = 45
# (month, day) from / to, both inclusive, wrapping over New Year.
RETURN_HOLIDAYS = ((11, 15), (1, 15))
HIGH_RETURN_RATE = 0.30
RETURNS_IN_SIX_MONTHS = 3
# (from, to, to is inclusive, tier, response hours)
REFUND_TIERS = (
    (0.0, 50.0, False, "auto", None),
    (50.0, 200.0, True, "manager", 4),
    (200.0, None, True, "director", 24),
)
RETURN_COST_RATE = 0.15
HIGH_MARGIN_PCT = 50.0
MONTHLY_RETURN_TARGET = 0.08
DISCONTINUED_CREDIT_RATE = 0.20

# --- damage claims (fixed values) -------------------------------------------

CLAIMS_IN_SIX_MONTHS = 2
HIGH_VALUE = 100.0
LATE_CLAIM_DAYS = 7
NOTIFY_VALUE = 200.0
PHOTO_REMINDER_HOURS = 48
PHOTO_CLOSE_HOURS = 72
LOW_STOCK_UNITS = 10
GRADE_A_CREDIT = 10.0
DISCOUNT_BY_GRADE = {"A": 0, "B": 10, "C": 15}
MULTIPLE_DAMAGE_DISCOUNT = 20
HIGH_VALUE_DISCOUNT = 15
CARRIER_CLAIM_MIN_VALUE = 50.0
CARRIER_MONTHLY_REVIEW = 3
CARRIER_MONTHLY_ESCALATE = 5
CARRIER_DAMAGE_RATE = 0.01
DAMAGE_RATE_TARGET = 0.005
RECOVERY_TARGET = 0.60
WRONG_ITEM_DISCOUNT = 15
MISSING_ITEM_DISCOUNT = 10

# --- shipping (fixed values) ------------------------------------------------

# zone, method, charge, order value that ships free, min / max business days
SHIPPING_RATES = (
    ("US", "standard", 5.95, 50.0, 5, 7),
    ("US", "expedited", 12.95, None, 2, 3),
    ("US", "express", 24.95, None, 1, 2),
    ("APO", "standard", 5.95, 50.0, 10, 20),
    ("APO", "expedited", 12.95, None, 10, 20),
    ("APO", "express", 24.95, None, 10, 20),
    ("CA", "standard", 15.95, 100.0, 7, 10),
    ("CA", "expedited", 15.95, 100.0, 7, 10),
    ("CA", "express", 15.95, 100.0, 7, 10),
    ("UK_EU", "standard", 24.95, 100.0, 10, 15),
    ("UK_EU", "expedited", 24.95, 100.0, 10, 15),
    ("UK_EU", "express", 24.95, 100.0, 10, 15),
    ("AU", "standard", 29.95, 100.0, 12, 18),
    ("AU", "expedited", 29.95, 100.0, 12, 18),
    ("AU", "express", 29.95, 100.0, 12, 18),
)
SHIPPING_COST = {"standard": 3.50, "expedited": 8.50, "express": 18.00}
DOMESTIC_ZONES = ("US", "APO")
LOST_AFTER_DAYS = {"domestic": 10, "international": 25}
# (more than N days late, credit, reship)
DELAY_CREDITS = ((15, 10.0, False), (20, 20.0, True))
CONTACT_CARRIER_DAYS = {"domestic": 10, "international": 7}
SUCCESS_TARGET = 0.98
LOSS_TARGET = 0.002
FAILING_MONTHS = 2
DAMAGES_IN_A_MONTH = 3
UPGRADE_DELAY_DAYS = 15
QA_HOLD_UNITS = 10
PROCESSING_HOURS = 24
BUSY_PROCESSING_HOURS = 48
PEAK_PROCESSING_HOURS = 72
SHIPPING_PEAK = ((11, 15), (1, 5))
RETRY_DAYS = 7

# --- embedding models (fixed values): price per 1,000 tokens ----------------

MODEL_PRICES = {
    "text-embedding-3-small": 0.00002,
    "text-embedding-3-large": 0.00013,
}
DEFAULT_MODEL_PRICE = 0.00002

DOCUMENT_CATEGORIES = ("policy_sop", "product_knowledge", "multi_source")
ACCURACY_GAP_POINTS = 5.0
