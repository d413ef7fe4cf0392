"""Fixed values.

Values that must equal the reference's for right results are stated here
plainly and together.  Everything else in the package derives from them.
"""

import datetime as _dt

# --- fixed values: order statuses, payment methods, return reasons ---------
ORDER_STATUSES = ["placed", "shipped", "delivered", "cancelled", "returned"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "gift_card"]
RETURN_REASONS = [
    "defective",
    "wrong_item",
    "no_longer_needed",
    "damaged_in_shipping",
    "changed_mind",
]

# --- fixed values: RFM segment thresholds (score total >= threshold) ------
RFM_SEGMENTS = [(12, "champion"), (9, "loyal"), (6, "at_risk")]
RFM_DEFAULT_SEGMENT = "lost"
RFM_SEGMENT_NAMES = ["champion", "loyal", "at_risk", "lost"]
RFM_BUCKETS = 5

# --- fixed values: date text formats accepted by the cleaning step --------
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
US_DATE_PATTERN = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"
US_DATE_FORMAT = "MM/dd/yyyy"
BOOLEAN_TRUE_SPELLINGS = ["true", "1"]

# --- analysis date for the driver tables (their last year ends on it) ------
DEFAULT_AS_OF = _dt.date(2001, 12, 31)
