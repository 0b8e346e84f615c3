"""Labels and constants that appear in results and so have to stay exactly as they are."""

from datetime import date

# Default calendar.
CALENDAR_START = date(2023, 1, 1)
CALENDAR_END = date(2025, 12, 31)

# Season tags by month.
SEASONS = {
    "Tet Season": (1, 2),
    "Summer": (5, 6, 7, 8),
    "Year-End": (11, 12),
}
SEASON_OTHERWISE = "Regular"

# Sales channels of the sales mart.
SELL_IN = "Sell-In"
SELL_OUT_GT = "Sell-Out GT"
POS_MT = "POS Modern Trade"
ECOMMERCE = "Ecommerce"

# Store types that are not taken from a source column.
STORE_TYPE_MODERN = "Modern Trade"
STORE_TYPE_ONLINE = "Online"

# Channels of the innovation mart.
INNOVATION_POS = "POS"
INNOVATION_GT = "GT"

# Promotion mart: values of a day without promotion, and the baseline frame in rows.
NO_PROMOTION_ID = "NONE"
NO_PROMOTION_TYPE = "No Promotion"
ON_PROMOTION_STATUS = "On Promotion"
BASELINE_ROWS = 30

# Months after launch shown in the cohort report.
COHORT_MONTHS = (1, 3, 6, 12)

# Rows of the top-promoted report and of the documented sample query.
TOP_PRODUCTS = 20
SAMPLE_ROWS = 20

# Demand curves: seasonal factors by month, yearly growth, adoption ramp.
SEASON_FACTORS = {
    1.6: (1, 2),
    1.4: (5, 6, 7, 8),
    1.2: (11, 12),
}
SEASON_FACTOR_OTHERWISE = 1.0
YEARLY_GROWTH = 0.40
ADOPTION_START = 0.1
ADOPTION_STEP = 0.15
