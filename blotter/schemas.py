"""Declared schemas and the constants the data model fixes."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def schema_of(text: str) -> T.StructType:
    """Schema from lines of ``name type``; the line order is the column order."""
    pairs = (line.split() for line in text.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, types and order of the incident table.
INCIDENTS = schema_of("""
cmplnt_num string
addr_pct_cd int
boro_nm string
cmplnt_fr_dt timestamp
cmplnt_fr_tm string
cmplnt_to_dt timestamp
cmplnt_to_tm string
crm_atpt_cptd_cd string
hadevelopt string
housing_psa int
jurisdiction_code int
juris_desc string
ky_cd int
law_cat_cd string
loc_of_occur_desc string
ofns_desc string
parks_nm string
patrol_boro string
pd_cd int
pd_desc string
prem_typ_desc string
rpt_dt timestamp
station_name string
susp_age_group string
susp_race string
susp_sex string
transit_district int
vic_age_group string
vic_race string
vic_sex string
x_coord_cd int
y_coord_cd int
latitude double
longitude double
""")
INCIDENT_KEY = "cmplnt_num"

# Acknowledgement table.
ACKS = schema_of("""
id string
status string
""")
ACK_KEY = "id"
SENT = "sent"

# Public events table.
PUBLIC_EVENTS = schema_of("""
event_id int
event_name string
start_date_time timestamp
end_date_time timestamp
event_agency string
event_type string
event_borough string
event_location string
event_street_side string
street_closure_type string
community_board string
police_precinct string
""")
PUBLIC_EVENT_KEY = "event_id"

# Forecast table. The time of day is text because Spark 4.1 refuses TIME
# columns unless asked; the id is a content hash instead of a sequence.
FORECASTS = schema_of("""
id string
latitude double
longitude double
addr_pct_cd string
boro_nm string
prediction_date date
prediction_time string
prediction string
probability double
""")
# Longest text the forecast table accepts per column.
FORECAST_WIDTHS = {"addr_pct_cd": 10, "boro_nm": 50, "prediction": 100}

# Fields a scoring request must carry.
REQUEST_FIELDS = [
    "addr_pct_cd", "boro_nm", "cmplnt_fr_dt", "cmplnt_fr_tm", "latitude", "longitude",
]
# Fields a training record must carry.
TRAINING_FIELDS = [
    "addr_pct_cd", "boro_nm", "cmplnt_fr_dt", "cmplnt_fr_tm", "ofns_desc",
    "latitude", "longitude",
]
LABEL = "ofns_desc"
# Model inputs, in model order.
FEATURES = ["month", "h_sin", "h_cos", "w_sin", "w_cos", "lat", "lon", "pct_enc", "bor_enc"]
# Category columns and the names of their codes.
CATEGORIES = {"addr_pct_cd": "pct_enc", "boro_nm": "bor_enc"}

# Columns shown on the map.
MAP_COLUMNS = [
    "cmplnt_num", "latitude", "longitude", "cmplnt_fr_dt", "cmplnt_fr_tm", "boro_nm", "pd_desc",
]
# Columns a search may name.
SEARCH_COLUMNS = ["latitude", "cmplnt_fr_dt", "cmplnt_fr_tm", "boro_nm", "pd_desc"]
SEARCH_MIN = 4

PAGE_ROWS = 1000
RELEASE_ROWS = 900
TOP_LABELS = 5
SLOT_MINUTES = 10
UNKNOWN_CODE = -1
DEFAULT_PRECINCT = "114"
TEST_SHARE = 0.2
SEED = 42
