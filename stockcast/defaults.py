"""Fixed default values: table layout, horizon, costs and drift settings."""

KEYS = ("Store", "Dept")
STORE = "Store"
DATE = "Date"
TARGET = "Weekly_Sales"
HOLIDAY = "IsHoliday"
PREDICTION = "y_pred"
MONTH = "date_month"  # partition column of dated tables: year * 100 + month

HORIZON_DAYS = 28
SEASON_DAYS = 364  # 52 weeks
COST_UNDER = 6.0
COST_OVER = 1.5

LAGS = (1, 2, 3, 4)
WINDOWS = (4, 8, 12)
MACRO_COLS = (
    "Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3",
    "MarkDown4", "MarkDown5", "CPI", "Unemployment",
)

N_BINS = 10
TOP_K = 30
PSI_THRESHOLD = 0.2
TOP_FEATURES = 10
