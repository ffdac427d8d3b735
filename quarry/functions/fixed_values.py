"""Fixed values that results depend on. Kept together, in natural order, as plain text."""

# --- fixed values: quote conventions --------------------------------------------------
HOME_PER_UNIT = "KES_PER_UNIT"
UNITS_PER_HOME = "UNITS_PER_KES"

# --- fixed values: published currency labels (normalised form) -> (code, basis, lot size)
CURRENCY_LABELS = [
    ("US DOLLAR", "USD", HOME_PER_UNIT, 1),
    ("STG POUND", "GBP", HOME_PER_UNIT, 1),
    ("EURO", "EUR", HOME_PER_UNIT, 1),
    ("SA RAND", "ZAR", HOME_PER_UNIT, 1),
    ("AE DIRHAM", "AED", HOME_PER_UNIT, 1),
    ("CAN $", "CAD", HOME_PER_UNIT, 1),
    ("S FRANC", "CHF", HOME_PER_UNIT, 1),
    ("JPY (100)", "JPY", HOME_PER_UNIT, 100),
    ("AUSTRALIAN $", "AUD", HOME_PER_UNIT, 1),
    ("NOR KRONER", "NOK", HOME_PER_UNIT, 1),
    ("SW KRONER", "SEK", HOME_PER_UNIT, 1),
    ("DAN KRONER", "DKK", HOME_PER_UNIT, 1),
    ("SAUDI RIYAL", "SAR", HOME_PER_UNIT, 1),
    ("IND RUPEE", "INR", HOME_PER_UNIT, 1),
    ("CHINESE YUAN", "CNY", HOME_PER_UNIT, 1),
    ("SINGAPORE DOLLAR", "SGD", HOME_PER_UNIT, 1),
    ("SINGAPORE $", "SGD", HOME_PER_UNIT, 1),
    ("HONGKONG DOLLAR", "HKD", HOME_PER_UNIT, 1),
    ("KES / TSHS", "TZS", UNITS_PER_HOME, 1),
    ("KES / USHS", "UGX", UNITS_PER_HOME, 1),
    ("KES/USHS", "UGX", UNITS_PER_HOME, 1),
    ("KES / RWF", "RWF", UNITS_PER_HOME, 1),
    ("KES / BIF", "BIF", UNITS_PER_HOME, 1),
]

# --- fixed values: month names in calendar order ------------------------------------
MONTH_NAMES = ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST",
               "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"]

# --- fixed values: annual indicator codes and countries --------------------------------
INDICATOR_CODES = ["FX.OWN.TOTL.ZS", "PA.NUS.FCRF"]
INDICATOR_COUNTRIES = ["KEN", "RWA", "TZA", "UGA"]
RATE_INDICATOR = "PA.NUS.FCRF"
OWNERSHIP_INDICATOR = "FX.OWN.TOTL.ZS"
HOME_COUNTRY = "KEN"
REGIONAL_CURRENCIES = ["TZS", "UGX", "RWF", "BIF"]

# --- fixed values: scraped monthly statistics table -----------------------------------
MOBILE_TABLE_ID = "table_1"
MOBILE_HEADERS = [
    "Year",
    "Month",
    "Active Agents",
    "Total Registered Mobile Money Accounts (Millions)",
    "Total Agent Cash in Cash Out (Volume Million)",
    "Total Agent Cash in Cash Out (Value KSh billions)",
]
MOBILE_COLUMNS = ["year_raw", "month_raw", "active_agents_raw", "registered_accounts_millions_raw",
                  "agent_cico_volume_million_raw", "agent_cico_value_ksh_billions_raw"]

# --- fixed values: bronze layouts --------------------------------------------------------
FX_COLUMNS = ["date_raw", "currency_raw", "mean_raw", "buy_raw", "sell_raw"]
INDICATOR_COLUMNS = ["indicator_id", "indicator_name", "country_iso3", "country_name", "year",
                     "value", "unit", "obs_status"]
METRIC_ID_COLUMNS = ["Measure", "Geo_view", "Geo_name", "Attribute", "Unit", "Metric"]
METRIC_COLUMNS = ["measure_raw", "geo_view_raw", "geo_name_raw", "attribute_raw", "unit_raw",
                  "metric_raw", "period_raw", "value_raw"]

# --- fixed values: reconciliation gate --------------------------------------------------
MIN_COVERAGE_DAYS = 200
RECON_TOLERANCE = 0.01
