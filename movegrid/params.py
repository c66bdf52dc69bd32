"""Fixed domain values the results depend on.

FIXED VALUES: the lists and tables below must stay exactly as they are for the
results to agree with the behaviour this library reproduces.  They are stated
plainly, in their natural order.
"""
from __future__ import annotations

# FIXED VALUES — track cleaning defaults (inclusive box, speed cap in degrees/day)
TRACK_LAT_RANGE = (40.0, 70.0)
TRACK_LON_RANGE = (-20.0, 20.0)
TRACK_MAX_SPEED = 10.0

# FIXED VALUES — season of each month (meteorological seasons)
SEASON_BY_MONTH = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Autumn", 10: "Autumn", 11: "Autumn",
}

# FIXED VALUES — name keywords of plankton variables
PLANKTON_KEYWORDS = [
    "acartia", "calanus", "metridia", "oithona", "temora",
    "copepod", "plankton", "zooplankton", "phytoplankton",
    "abundance", "biomass", "concentration",
]

# FIXED VALUES — name keywords of environmental variables
ENVIRONMENT_KEYWORDS = [
    "temperature", "temp", "salinity", "salt", "nitrate", "nitrite",
    "phosphate", "silicate", "oxygen", "chlorophyll", "chl",
    "depth", "pressure", "density",
]

# FIXED VALUES — keywords of the per-variable summaries (narrower lists)
PLANKTON_SUMMARY_KEYWORDS = ["acartia", "calanus", "metridia", "oithona", "temora", "abundance"]
ENVIRONMENT_SUMMARY_KEYWORDS = ["temperature", "salinity", "nitrate", "phosphate", "silicate"]

# FIXED VALUES — keywords that identify elasmobranch species (EN, FR, ES, RU, ZH)
ELASMOBRANCH_KEYWORDS = [
    "shark", "ray", "skate", "chimaera", "elasmobranch",
    "mako", "thresher", "basking", "tiger", "sixgill",
    "squale", "requin", "raie", "chimère",
    "tiburón", "raya", "quimera",
    "акула", "скат", "химера",
    "鲨鱼", "鳐鱼", "银鲛",
]

# FIXED VALUES — species dimension columns searched for keywords
SPECIES_SEARCH_COLUMNS = ["name_en", "name_fr", "name_es", "scientific_name", "group_en"]

# FIXED VALUES — fishing area code, name, lat_min, lat_max, lon_min, lon_max
AREA_BOUNDS = [
    (18, "Arctic Sea", 60.0, 85.0, -180.0, 180.0),
    (21, "Atlantic, Northwest", 40.0, 70.0, -80.0, -40.0),
    (27, "Atlantic, Northeast", 40.0, 70.0, -20.0, 40.0),
    (31, "Atlantic, Western Central", 0.0, 40.0, -80.0, -20.0),
    (34, "Atlantic, Eastern Central", 0.0, 40.0, -20.0, 20.0),
    (37, "Mediterranean and Black Sea", 30.0, 45.0, -5.0, 40.0),
    (41, "Atlantic, Southwest", -40.0, 0.0, -80.0, -20.0),
    (47, "Atlantic, Southeast", -40.0, 0.0, -20.0, 20.0),
    (48, "Atlantic, Antarctic", -80.0, -40.0, -80.0, 20.0),
    (51, "Indian Ocean, Western", -40.0, 30.0, 20.0, 80.0),
    (57, "Indian Ocean, Eastern", -40.0, 30.0, 80.0, 140.0),
    (58, "Indian Ocean, Antarctic", -80.0, -40.0, 20.0, 140.0),
    (61, "Pacific, Northwest", 20.0, 60.0, 120.0, 180.0),
    (67, "Pacific, Northeast", 20.0, 60.0, -180.0, -120.0),
    (71, "Pacific, Western Central", -20.0, 20.0, 120.0, 180.0),
    (77, "Pacific, Eastern Central", -20.0, 20.0, -180.0, -120.0),
    (81, "Pacific, Southwest", -60.0, -20.0, 120.0, 180.0),
    (87, "Pacific, Southeast", -60.0, -20.0, -180.0, -120.0),
    (88, "Pacific, Antarctic", -80.0, -60.0, 120.0, -120.0),
    (98, "Antarctic areas NEI", -80.0, -40.0, -180.0, 180.0),
    (99, "Marine areas outside Antarctic", -40.0, 80.0, -180.0, 180.0),
]

# Region of the "North Sea" report and the default focus area of the raster
NORTH_SEA_AREA = 27

# FIXED VALUES — image categories by file-stem keyword (species win over environment)
IMAGE_SPECIES_KEYWORDS = ["acartia", "calanus", "metridia", "oithona", "temora"]
IMAGE_ENV_KEYWORDS = ["temperature", "salinity", "nitrate", "phosphate", "silicate"]
# Overlay bounds (south, west, north, east) of the gallery layers
IMAGE_OVERLAY_BOUNDS = (50.0, 1.0, 55.0, 5.0)

# FIXED VALUES — PNG colour type -> image mode
PNG_COLOR_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}

# Model defaults
MODEL_SEED = 42
MODEL_TEST_SIZE = 0.2
FOREST_TREES = 100
FOREST_DEPTH = 10
FOREST_MIN_LEAF = 2
