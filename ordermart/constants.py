"""Fixed values that must equal the reference's for identical results.

Fixed values (kept verbatim, in natural order):

* product categories, indexed by an MD5 bucket of the seller id;
* seller regions, cycled over seller numbers;
* status aliases per canonical status (case-sensitive lists);
* seller tiers by seller number and their names;
* the twelve forecast feature columns, in vector order.
"""

# --- fixed values -----------------------------------------------------------
CATEGORIES = (
    "electronics", "clothing", "home_garden", "sports", "beauty",
    "books", "food_drink", "toys", "automotive", "health",
)

REGIONS = ("north", "south", "central", "west", "east")

STATUS_ALIASES = (
    ("completed", ("completed", "done", "success", "paid", "complete", "COMPLETED")),
    ("cancelled", ("cancelled", "cancel", "CANCEL", "CANCELLED")),
    ("returned", ("returned", "return", "refund", "REFUND")),
    ("pending", ("pending", "PENDING", "processing", "in_progress")),
)
UNKNOWN_STATUS = "unknown"

# seller number i in 1..N_SELLERS: i <= 60 high, i <= 160 average, else low
N_SELLERS = 200
TIER_LIMITS = ((60, "high_performer"), (160, "average_seller"))
LOWEST_TIER = "low_performer"
TIER_CODES = (("high_performer", 2.0), ("average_seller", 1.0))  # anything else 0.0

FEATURE_COLUMNS = (
    "month", "monthly_revenue", "avg_order_value",
    "cancel_rate", "unique_customers", "active_days",
    "lag1_revenue", "lag2_revenue", "lag3_revenue",
    "revenue_ma3", "growth_rate", "seller_type_enc",
)
LABEL_COLUMN = "next_month_revenue"
# --- end of fixed values ----------------------------------------------------

N_PRODUCTS = 500
PRODUCT_ID_WIDTH = 5
CATEGORY_HEX_CHARS = 8
