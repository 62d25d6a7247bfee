"""Statuses, types, labels, thresholds and bin edges of the data model."""

# Order statuses with a meaning of their own; every other status is carried along.
DELIVERED = "delivered"
CANCELED = "canceled"
UNAVAILABLE = "unavailable"

# Payment types. INVALID_PAYMENT is removed at ingest.
INVALID_PAYMENT = "not_defined"
CREDIT_CARD = "credit_card"
BOLETO = "boleto"
DEBIT_CARD = "debit_card"
VOUCHER = "voucher"
PAYMENT_TYPES = (CREDIT_CARD, BOLETO, DEBIT_CARD, VOUCHER)

# Spending segments and the smallest total_spent of each (inclusive).
PREMIUM, HIGH, REGULAR = "Premium", "High", "Regular"
SEGMENTS = (PREMIUM, HIGH, REGULAR)
PREMIUM_MIN = 400
HIGH_MIN = 200
NEAR_MIN, NEAR_MAX = 150, 200

LEAKAGE_LABELS = {CANCELED: "Canceled Order", UNAVAILABLE: "Unavailable Order"}

# Order value histogram: (exclusive upper edge, label); None is the open last bin.
ORDER_VALUE_BINS = (
    (50, "R$0-50"),
    (100, "R$50-100"),
    (150, "R$100-150"),
    (200, "R$150-200"),
    (250, "R$200-250"),
    (300, "R$250-300"),
    (400, "R$300-400"),
    (500, "R$400-500"),
    (None, "R$500+"),
)

# Coarse value ranges of the cancel-rate report, same form.
VALUE_RANGES = (
    (100, "Low (<R$100)"),
    (300, "Mid (R$100-300)"),
    (None, "High (>R$300)"),
)

SINGLE_PAYMENT, INSTALLMENT = "1x (Single Payment)", "2x+ (Installment)"
WITH_VOUCHER, WITHOUT_VOUCHER = "With Voucher", "Without Voucher"
VOUCHER_USER, NON_VOUCHER = "Voucher User", "Non-Voucher"

SPENDING_BIN_WIDTH = 100
SPENDING_BINS_SHOWN = 20
TARGET_FACTOR = "1.2"
MIN_STATE_CUSTOMERS = 50
MISSED_UPSELL_MIN_PRICE = 150

# Regional opportunity tiers.
TIER_HIGH, TIER_MEDIUM, TIER_LOW = "High Priority", "Medium Priority", "Low Priority"
TIER_HIGH_REVENUE = 500_000
TIER_MEDIUM_REVENUE = 200_000
TIER_MAX_INSTALLMENTS = 3

# Upgrade scenarios: percent of near-threshold rows converted, value of one conversion.
SCENARIO_PERCENTS = (10, 25, 50, 100)
SCENARIO_VALUE = 200

# Texts that stand for a missing value in the source files.
MISSING_MARKERS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
