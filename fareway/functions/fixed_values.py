"""Fixed values of the business: codes, labels, bounds, weights, targets.

Results depend on these exact values; they are stated once here and passed to the operators.
"""

LOCAL_ZONE = "Asia/Dubai"

# Journey status codes.
COMPLETED = (9, 10)
CUSTOMER_CANCELLED = (13,)
DRIVER_CANCELLED = (14,)
ADMIN_CANCELLED = (15, 19)
METER_JOB = (9, 10, 11, 12, 18)
CHAIN_DRIVER_CANCELLED = (12,)
SETTLED_STATUS_TEXTS = ("PAYMENT_RECEIVED", "JOURNEY_COMPLETED")

# User types.
CUSTOMER_TYPE = 1
DRIVER_TYPE = 2

# Vehicle category ids of taxis; every other category is a limo.
TAXI_CATEGORIES = ("65d4bce6d30d222a7c7921b9", "65d4bce6d30d222a7c7921ba")

# Supplier ids and names.
SUPPLIERS = {
    "67178c298f4c4d9d4657633e": "Kabi",
    "676125c8c9abe86ca466af9a": "National Taxi",
    "68b6f317881686da85284ea7": "DTC",
}

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday")
MON_THU = WEEKDAYS[:4]
FRI_SUN = ("Friday", "Saturday", "Sunday")
WEEKEND = ("Saturday", "Sunday")

# Fixed values: (days, hours, label), first match wins. `None` days means every day.
PEAK_RULES = (
    (WEEKDAYS, (8, 9), "morning_super_peak"),
    (None, (16, 17, 18, 19, 20), "Evening_peak"),
    (WEEKEND, (8, 9), "Morning_peak"),
)
PEAK_OTHER = "Others"

SHIFT_RULES = (
    (WEEKDAYS, (8, 9), "Morning_peak"),
    (MON_THU, (16, 17, 18, 19), "Evening_weekday_peak"),
    (FRI_SUN, (16, 17, 18, 19, 20, 21), "Weekend_evening_peak"),
    (FRI_SUN, (22, 23), "Weekend_mid_night"),
    (None, (0, 1, 2, 3, 4, 5), "LateNight0_5"),
    (MON_THU, (22, 23), "Weekday_mid_night"),
)
SHIFT_OTHER = "Others"

# Taxi revenue per completed trip by slot, and the limo share of the fare.
TAXI_REVENUE_RULES = (
    (WEEKDAYS, (8, 9), 7.0),
    (MON_THU, (16, 17, 18, 19), 7.0),
    (FRI_SUN, (16, 17, 18, 19, 20, 21), 7.0),
    (FRI_SUN, (22, 23), 6.5),
    (None, (0, 1, 2, 3, 4, 5), 3.5),
    (MON_THU, (22, 23), 3.5),
)
TAXI_REVENUE_OTHER = 3.0
LIMO_REVENUE_SHARE = 0.2

# Ordered upper bounds (inclusive) with labels; the last entry is the remainder.
PRICE_BOUNDS = (0.0, 0.05, 0.10, 0.15, 0.20)
PRICE_LABELS = ("0.<=0", "1.0–5%", "2.5–10%", "3.10–15%", "4.15–20%", "5.>20%")
IMPACT_PRICE_LABELS = ("0.less_than 0",) + PRICE_LABELS[1:]
FEE_BOUNDS = (30.0, 50.0, 70.0)
FEE_LABELS = ("0.<30", "1.30-50", "2.50-70", "3.>70")
IMPACT_FEE_LABELS = ("0.Less_than_30", "1.30_50", "2.50_70", "3>70")
SCORE_BOUNDS = (0.2, 0.4, 0.6, 0.8, 1.0)
SCORE_LABELS = (
    "0.less_then0.2", "1.less_then0.4", "2.less_then0.6", "3.less_then0.8", "4.less_then1",
)
RECENCY_BOUNDS = (7, 14, 30, 90, 180)
RECENCY_LABELS = (
    "Active_This_Week", "Active_Past2_Week", "Active_This_Month", "Active_Last_3_Months",
    "Dormant_3_6M", "Dormant_6Mplus",
)
RECENCY_BUCKET_BOUNDS = (7, 30, 90)
RECENCY_BUCKET_LABELS = ("0-7_days", "8-30_days", "31-90_days", "90+_days")
NEVER_ACTIVE = "Never_Active"
EXPERIENCE_BOUNDS = (0, 4, 9)
EXPERIENCE_LABELS = ("0.new_0", "1.2–5", "2.6–10", "3.10Plus")
PRE_TICKET_BOUNDS = (0, 1, 4)
PRE_TICKET_LABELS = (
    "No Completed Trip Before Ticket", "1 Completed Trip Before Ticket",
    "2_5_completed_trips", "More than 5 completed trips",
)

# Keywords of place types in order of priority: (type, in zone name, in address).
PLACE_KEYWORDS = (
    ("Mall", ("mall", "city centre", "burjuman", "dragon mart"), ("mall",)),
    ("Airport", ("airport", "terminal"), ()),
    ("Metro", ("metro",), ("metro",)),
    ("School", ("school",), ("school",)),
    ("College", ("college", "university"), ("college", "university")),
)
PLACE_OTHER = "Others"

# Journey type by the place type at either end, in order of priority.
JOURNEY_TYPES = (
    ("Mall", "Mall_Goer"), ("School", "School_Route"), ("College", "College_Route"),
    ("Metro", "Metro_Route"), ("Airport", "Airport_Traveler"),
)
JOURNEY_TYPE_OTHER = "General"

# Badges that spoil a good rating.
BAD_BADGES = ("Dirty car", "Bad odour", "Unfriendly chat")

# Logistic midpoints and slopes, and score weights.
LOGISTIC = {"cr": (0.60, 0.30), "dc": (0.10, -12.0), "rt": (3.5, 2.00), "acc": (0.50, 7.0)}
SCORE_WEIGHTS = {"cr": 0.40, "dc": 0.40, "rt": 0.20}
SCORE_WEIGHTS_ACCEPTANCE = {"acc": 0.40, "cr": 0.35, "dc": 0.10, "rt": 0.15}
LIFETIME_WEIGHT, RECENT_WEIGHT = 0.40, 0.60
DISPATCH_WEIGHTS = {"eta_score": 0.8, "final_score": 0.2}

# KPI rows as (order, name, monthly target).
KPI_METRICS = {
    "requests": (1, "Total Journey Request", 266815.0),
    "completed": (2, "Total Completed Journey", 160089.0),
    "completion_rate": (3, "Total Completion Rate", 60.0),
    "cancellation_rate": (5, "Total Cancellation Rate", 40.0),
    "revenue": (6, "Total ZED Revenue", 0.0),
    "driver_cancel_rate": (10, "Driver Cancelled %", 10.0),
    "customer_cancel_rate": (11, "Customer Cancelled %", 30.0),
    "avg_eta": (17, "Avg Dispatch ETA", 3.5),
    "avg_ata": (18, "Avg ATA", 3.5),
    "new_users": (23, "New User Count", 28601.0),
    "existing_users": (24, "Existing User Count", 23696.0),
    "trip_frequency": (25, "Avg Trip Frequency Active Users", 3.16),
    "sessions": (28, "Total Unique Session Count", 607341.0),
    "session_conversion": (29, "Session Conversion Rate", 37.0),
    "good_ratings": (30, "Customer Ratings ≥ 4 %", 98.0),
    "short_eta": (31, "≤ 3.5 Minutes ETA %", 0.0),
    "short_ata": (32, "≤ 3.5 Minutes ATA %", 0.0),
    "own_share": (33, "ZED % Share", 0.0),
}
SHORT_WAIT_SECONDS = 210
