"""Fixed values that results depend on."""

LITRES_PER_US_GALLON = 3.785411784
CURRENCY_OF_UNIT = {
    "USD/gal": "USD",
    "USD/L": "USD",
    "CAD/L": "CAD",
    "MXN/L": "MXN",
    "GBp/L": "GBP",
    "AUD/L": "AUD",
    "JPY/L": "JPY",
    "TWD/L": "TWD",
}
#: Inclusive bounds of a plausible price in its unit, and of single labels.
BOUNDS = {
    "USD/gal": (2.0, 11.0),
    "USD/L": (0.5, 2.5),
    "CAD/L": (1.0, 3.5),
    "MXN/L": (15.0, 40.0),
    "GBp/L": (100.0, 250.0),
    "AUD/L": (1.2, 3.4),
    "JPY/L": (90.0, 250.0),
    "TWD/L": (20.0, 45.0),
}
LABEL_BOUNDS = {("JPY/L", "Kerosene"): (60.0, 250.0)}
MOVE_EPSILON = 5e-5
OUT_OF_BOUNDS_SHARE = 0.05
RECENT_ERRORS = 3
CARRY_DAYS = 7
SEEN_DAYS = 30
CLOSED_AFTER_DAYS = 45
STALE_AFTER_DAYS = {"JP": 10, "TW": 14}
STALE_AFTER_DEFAULT = 3
FLOORS = {"US": 585, "CA": 78, "MX": 18, "GB": 21, "AU": 14, "JP": 26, "TW": 3, "US-SAMS": 460}
ID_BATCH = 10
LOOK_AHEAD = 200
WATCH_CAP = 25
PUBLISH_FAILURES, CAPTURE_FAILURES = 2, 3
DASHBOARD_STALE_HOURS = 12
CORE_GRADES = ("regular", "premium", "diesel")
STATUS_RANK = {"failed": 0, "degraded": 1, "ok": 2, "skipped": 3}
