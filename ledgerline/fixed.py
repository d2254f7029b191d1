"""Fixed values of the domain: table layouts, header aliases, column lists, constants."""

# --- Fixed values: table layouts (column -> type). "time" is stored as int seconds since midnight. ---

AUDIT_COLUMNS = {
    "audit_key": "bigint",
    "_created_at": "timestamp",
    "_updated_at": "timestamp",
    "_source_file": "string",
}

DIM_DATE = {
    "date_key": "bigint",
    "full_date": "date",
    "day": "bigint",
    "month": "bigint",
    "year": "bigint",
    "quarter": "bigint",
    "is_trading_day": "boolean",
}

DIM_STOCK = {
    "stock_key": "bigint",
    "ticker": "string",
    "company_name": "string",
    "exchange": "string",
    "industry": "string",
}

DIM_BANK = {
    "bank_key": "bigint",
    "bank_code": "string",
    "bank_name": "string",
    "bank_type": "string",
    "charter_capital": "double",
    "valid_from": "date",
    "valid_to": "date",
    "is_current": "boolean",
}

DIM_TRADING_SESSION = {
    "session_key": "bigint",
    "session_name": "string",
    "start_time": "time",
    "end_time": "time",
}

DIM_AUDIT = {
    "audit_key": "bigint",
    "run_id": "string",
    "run_timestamp": "timestamp",
    "script_name": "string",
    "source_file": "string",
    "rows_processed": "bigint",
    "status": "string",
}

FACT_STOCK_DAILY_METRICS = {
    "date_key": "bigint",
    "stock_key": "bigint",
    "open_price": "double",
    "high_price": "double",
    "low_price": "double",
    "close_price": "double",
    "trading_volume": "bigint",
    "price_change": "double",
    "price_change_pct": "double",
    "price_amplitude": "double",
    "volume_change_pct": "double",
    "trading_value": "double",
}

FACT_BANK_PERFORMANCE = {
    "date_key": "bigint",
    "bank_key": "bigint",
    "total_assets": "double",
    "total_deposits": "double",
    "total_loans": "double",
    "total_equity": "double",
    "num_employees": "bigint",
    "num_branches": "bigint",
    "npl_amount": "double",
    "loan_loss_provision": "double",
    "interest_income": "double",
    "interest_expense": "double",
    "net_interest_income": "double",
    "non_interest_expense": "double",
    "personnel_expense": "double",
    "other_expense": "double",
    "profit_before_tax": "double",
    "profit_after_tax": "double",
    "off_balance_sheet": "double",
    "npl_ratio": "double",
    "llp_ratio": "double",
    "roa": "double",
    "roe": "double",
    "nim": "double",
    "cir": "double",
    "eta": "double",
    "etd": "double",
    "lta": "double",
    "ltd": "double",
    "gta": "double",
    "is_imputed": "boolean",
}

BANK_CLUSTER_ASSIGNMENTS = {
    "bank_key": "bigint",
    "bank_code": "string",
    "bank_name": "string",
    "bank_type": "string",
    "cluster_id": "bigint",
    "cluster_name": "string",
    "model_name": "string",
}

BANK_RISK_PREDICTIONS = {
    "bank_key": "bigint",
    "bank_code": "string",
    "date_key": "bigint",
    "risk_label": "bigint",
    "risk_probability": "double",
    "actual_npl_ratio": "double",
    "model_name": "string",
}

FACT_MODEL_PREDICTIONS = {
    "base_date_key": "bigint",
    "stock_key": "bigint",
    "horizon": "string",
    "predicted_close_price": "double",
    "model_name": "string",
}

# --- Fixed values: source header -> canonical name ---

PRICE_HEADERS = {
    "Date": "date",
    "Ngày": "date",
    "time": "date",
    "Open": "open_price",
    "Mở cửa": "open_price",
    "open": "open_price",
    "High": "high_price",
    "Cao nhất": "high_price",
    "high": "high_price",
    "Low": "low_price",
    "Thấp nhất": "low_price",
    "low": "low_price",
    "Close": "close_price",
    "Đóng cửa": "close_price",
    "close": "close_price",
    "Volume": "trading_volume",
    "Khối lượng": "trading_volume",
    "volume": "trading_volume",
}

FOREIGN_HEADERS = {
    "Date": "date",
    "Ngày": "date",
    "time": "date",
    "Foreign Buy Volume": "foreign_buy_volume",
    "Foreign Sell Volume": "foreign_sell_volume",
    "Foreign Net Volume": "foreign_net_volume",
    "Foreign Net Value": "foreign_net_value",
    "Foreign Ownership": "foreign_ownership_ratio",
    "Foreign Ownership Ratio": "foreign_ownership_ratio",
}

PROPRIETARY_HEADERS = {
    "Date": "date",
    "Ngày": "date",
    "time": "date",
    "Prop Buy Volume": "prop_buy_volume",
    "Prop Sell Volume": "prop_sell_volume",
    "Prop Net Volume": "prop_net_volume",
    "Prop Net Value": "prop_net_value",
}

ORDER_STATS_HEADERS = {
    "Date": "date",
    "Ngày": "date",
    "time": "date",
    "Total Buy Orders": "total_buy_orders",
    "Total Buy Volume": "total_buy_volume",
    "Total Sell Orders": "total_sell_orders",
    "Total Sell Volume": "total_sell_volume",
    "Matched Volume": "matched_volume",
}

BANK_LIST_HEADERS = {
    "No.": "bank_key",
    "Bank": "bank_name",
    "Bank Code": "bank_code",
    "Type of ownership": "bank_type",
}

STATEMENT_META = ["item", "item_en", "item_id", "unit", "levels", "row_number"]

RATIO_TECHNICAL_COLUMNS = [
    "year",
    "quarter",
    "ratioTTMId",
    "ratioType",
    "organCode",
    "yearReport",
    "ratioYearId",
]

BANK_HEADERS = {
    "Bank Code": "bank_code",
    "Year": "year",
    "Classification": "bank_type",
    "Number of Employees": "num_employees",
    "Number of Branches": "num_branches",
    "Labour productivity": "labour_productivity",
    "Network productivity": "network_productivity",
    "Employees Ratio": "employees_ratio",
    "Branches Ratio": "branches_ratio",
    "Total Deposits": "total_deposits",
    "Total Shareholder's Equity": "total_equity",
    "Total Loans": "total_loans",
    "Loan Loss Provisions": "loan_loss_provision",
    "Non-performing Loans": "npl_amount",
    "Total Fixed Assets": "total_fixed_assets",
    "Liquid Assets": "liquid_assets",
    "Total Assets": "total_assets",
    "Total Deposits Ratio": "total_deposits_ratio",
    "Total Loans Ratio": "total_loans_ratio",
    "Total Assets Ratio": "total_assets_ratio",
    "Interest Expenses": "interest_expense",
    "Non-Interest Expenses": "non_interest_expense",
    "Personnel Expenses": "personnel_expense",
    "Occupancy Expenses": "occupancy_expense",
    "Other Expenses": "other_expense",
    "Total Operating Expenses": "total_operating_expenses",
    "Core Cost": "core_cost",
    "Total Cost": "total_cost",
    "Core Cost Ratio": "core_cost_ratio",
    "Total Cost Ratio": "total_cost_ratio",
    "Interest Incomes": "interest_income",
    "Non-Interest Income": "non_interest_income",
    "Other Incomes": "other_income",
    "Total Income": "total_income",
    "Total Income Ratio": "total_income_ratio",
    "Equity Over Total Assets": "eta",
    "Equity Over Total Deposits": "etd",
    "Non-performing Loans Ratio": "npl_ratio",
    "Loan Loss Provisions Ratio": "llp_ratio",
    "Returns Over Assets": "roa",
    "Returns Over Equity": "roe",
    "Net Interest Margin": "nim",
    "Cost-Income Ratios": "cir",
    "Liquid Assets Over Total Assets": "liquid_assets_over_total_assets",
    "Liquid Assets Over Total Deposits": "liquid_assets_over_total_deposits",
    "Cumulative Gaps Over Total Assets": "cumulative_gaps_over_total_assets",
    "Off-balance Sheet Activities": "off_balance_sheet",
    "Profits Before Tax": "profit_before_tax",
    "Profits After Tax": "profit_after_tax",
}

# --- Fixed values: column lists ---

PERCENT_COLUMNS = [
    "employees_ratio",
    "branches_ratio",
    "total_deposits_ratio",
    "total_loans_ratio",
    "total_assets_ratio",
    "core_cost_ratio",
    "total_cost_ratio",
    "total_income_ratio",
    "eta",
    "etd",
    "npl_ratio",
    "llp_ratio",
    "roa",
    "roe",
    "nim",
    "cir",
    "liquid_assets_over_total_assets",
    "liquid_assets_over_total_deposits",
    "cumulative_gaps_over_total_assets",
]

IMPUTED_RATIOS = [
    "roa",
    "roe",
    "nim",
    "cir",
    "eta",
    "etd",
    "npl_ratio",
    "llp_ratio",
    "lta",
    "ltd",
    "gta",
]

CAMELS_FEATURES = [
    "roa",
    "roe",
    "nim",
    "cir",
    "eta",
    "etd",
    "lta",
    "ltd",
    "gta",
    "npl_ratio",
    "llp_ratio",
]

SCALE_FEATURES = ["total_assets", "total_deposits", "total_loans", "total_equity"]

FORECAST_FEATURES = [
    "close_price",
    "open_price",
    "high_price",
    "low_price",
    "trading_volume",
    "price_change_pct",
    "volume_change_pct",
]

# --- Fixed values: small dimensions ---

STOCKS = [
    (1, "BID", "Joint Stock Commercial Bank for Investment and Development of Vietnam", "HOSE", "Banking"),
    (2, "TCB", "Vietnam Technological and Commercial Joint Stock Bank", "HOSE", "Banking"),
    (3, "VCB", "Joint Stock Commercial Bank for Foreign Trade of Vietnam", "HOSE", "Banking"),
    (4, "CTG", "Vietnam Joint Stock Commercial Bank for Industry and Trade", "HOSE", "Banking"),
]

SESSIONS = [
    (1, "ATO", "09:00:00", "09:14:59"),
    (2, "Morning", "09:15:00", "11:29:59"),
    (3, "Afternoon", "13:00:00", "14:29:59"),
    (4, "ATC", "14:30:00", "14:45:00"),
]

EXCLUDED_BANKS = ["DAB", "CB", "GPB", "WEB", "VBSP", "MDB"]

BANK_TYPE_LABELS = {
    "SOCB": "state-owned commercial bank",
    "JSCB": "joint-stock commercial bank",
    "FOCB": "foreign-owned commercial bank",
}

# --- Fixed values: constants ---

CALENDAR_START = "2002-01-01"
CALENDAR_END = "2026-12-31"
FIRST_VALID_FROM = "2002-01-01"
OPEN_END = "9999-12-31"
PERCENT_LIMIT = 1.5
IMPUTE_CUTOFF_YEAR = 2006
RISK_THRESHOLD = 0.03
PCA_VARIANCE = 0.80
CLUSTERS = 3
TRAIN_SHARE = 0.8
AUC_GATE = 0.80
RECALL_GATE = 0.85
FORECAST_HORIZON = 5
FORECAST_WINDOW = 20
AR_ORDER = 5
ROLLING_WINDOWS = (60, 250)
MAPE_EPSILON = 1e-8
