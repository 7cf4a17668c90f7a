"""Rule sets and lookup tables, kept as data so that callers can swap them."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values. Results depend on them being exactly these.
# ---------------------------------------------------------------------------

LISTING_COLUMNS = [
    "brand", "model", "vehicleType", "power", "gearbox", "kilometer",
    "fuelType", "yearOfRegistration", "seller", "dataSource", "price", "price_tier",
]

# Column order matters for nothing but reports.
TEXT_COLUMNS = ["seller", "vehicleType", "gearbox", "model", "brand", "fuelType", "dataSource"]
NUMERIC_COLUMNS = ["price", "power", "kilometer", "yearOfRegistration"]

# Used-car consumer price index by crawl year; prices are restated in CPI_BASE_YEAR money.
CPI_USED_CARS = {
    2014: 99.5, 2015: 100.0, 2016: 100.5, 2017: 102.0, 2018: 103.8, 2019: 105.3, 2020: 100.0,
    2021: 109.1, 2022: 128.5, 2023: 138.9, 2024: 145.3, 2025: 147.1, 2026: 147.9,
}
CPI_BASE_YEAR = 2026

# Upper bounds (exclusive) of the two lower tiers; everything else is the top tier.
TIER_BOUNDS = (5000, 15000)
TIERS = ("budget", "mid-range", "luxury")
TIER_CODES = {"budget": 0, "mid-range": 1, "luxury": 2}

MISSING_PLACEHOLDERS = [
    "", " ", "?", "N/A", "n/a", "NA", "na", "null", "NULL", "None", "none", "unknown", "Unknown",
    "-", "--", "keine_angabe", "andere", "sonstige", "nan",
]

BRANDS_TO_DROP = ["sonstige-autos", "unbekannt", "keine_angabe"]
MODELS_TO_DROP = ["sonstige", "sonstige_autos", "keine_angabe"]

BRAND_ALIASES = {
    "alfa": "alfa-romeo", "land": "land-rover", "aston": "aston-martin", "lynk": "lynk-co",
    "alpine": "alpina", "merc": "mercedes-benz", "vw": "volkswagen", "landrover": "land-rover",
}
MODEL_ALIASES = {
    "kaefer": "beetle", "käfer": "beetle", "new-beetle": "beetle",
    "1er": "1-series", "2er": "2-series", "3er": "3-series", "4er": "4-series",
    "5er": "5-series", "6er": "6-series", "7er": "7-series", "8er": "8-series",
    "a-klasse": "a-class", "b-klasse": "b-class", "c-klasse": "c-class", "e-klasse": "e-class",
    "g-klasse": "g-class", "m-klasse": "m-class", "s-klasse": "s-class", "v-klasse": "v-class",
    "x-klasse": "x-class", "up!": "up", "e-up!": "e-up", "ceed": "ceed",
    "andere": "other", "unknown": "other",
}
FUEL_ALIASES = {
    "benzin": "gasoline", "elektro": "electric", "electric/gasoline": "hybrid",
    "electric/diesel": "hybrid", "andere": "other",
}
VEHICLE_ALIASES = {
    "limousine": "sedan", "kleinwagen": "compact", "kombi": "station-wagon", "bus": "van",
    "cabrio": "convertible", "suv/off-road/pick-up": "suv", "andere": "other",
}
SELLER_ALIASES = {"privat": "private", "gewerblich": "dealer"}
GEARBOX_ALIASES = {"manuell": "manual", "automatik": "automatic"}

# Strict maps of the source-alignment step: a value outside the map becomes null.
STRICT_GEARBOX = {"manuell": "manual", "automatik": "automatic"}
STRICT_SELLER = {"privat": "private", "gewerblich": "dealer"}
STRICT_FUEL = {
    "benzin": "gasoline", "diesel": "diesel", "hybrid": "hybrid", "elektro": "electric",
    "lpg": "lpg", "cng": "cng", "andere": "other",
}
STRICT_VEHICLE = {
    "limousine": "sedan", "kleinwagen": "compact", "kombi": "station_wagon", "bus": "van",
    "cabrio": "convertible", "coupe": "coupe", "suv": "suv", "andere": "other",
}

# Rules of the cleaning step (lower bounds double as the lower cap).
CLEANING_RULES = {
    "price": {"type": "double", "nullable": False, "min": 500.0, "max": 3000000.0},
    "power": {"type": "double", "nullable": False, "min": 5.0, "max": 3000.0},
    "kilometer": {"type": "double", "nullable": False, "min": 0.0, "max": 300000.0},
    "yearOfRegistration": {"type": "int", "nullable": False, "min": 1900, "max": 2026},
    "brand": {"type": "string", "nullable": False},
    "model": {"type": "string", "nullable": True},
    "vehicleType": {"type": "string", "nullable": True},
    "gearbox": {"type": "string", "nullable": True},
    "fuelType": {"type": "string", "nullable": True},
    "seller": {"type": "string", "nullable": True},
    "dataSource": {"type": "string", "nullable": True},
}

# Rules of the validation step; deliberately separate from the cleaning rules.
EXPECTED_TYPES = {
    "brand": "string", "model": "string", "vehicleType": "string", "power": "double",
    "gearbox": "string", "kilometer": "double", "fuelType": "string", "yearOfRegistration": "int",
    "seller": "string", "dataSource": "string", "price": "double", "price_tier": "string",
}
RANGE_RULES = {
    "price": (500, 5_000_000),
    "power": (5, 5_000),
    "kilometer": (0, 300_000),
    "yearOfRegistration": (1900, 2026),
}
CATEGORY_RULES = {
    "seller": ["private", "dealer"],
    "dataSource": ["kaggle", "crawled"],
    "gearbox": ["manual", "automatic", "semi-automatic"],
    "fuelType": ["gasoline", "diesel", "lpg", "cng", "hybrid", "electric", "other"],
    "vehicleType": ["sedan", "compact", "station_wagon", "van", "convertible", "coupe", "suv", "other"],
    "price_tier": ["budget", "mid-range", "luxury"],
}
REQUIRED_COLUMNS = [
    "price", "yearOfRegistration", "power", "kilometer", "model", "vehicleType", "fuelType",
    "gearbox", "dataSource", "price_tier", "seller",
]
MEAN_BOUNDS = {
    "price": (500, 30_000),
    "power": (50, 250),
    "kilometer": (10_000, 150_000),
    "yearOfRegistration": (1990, 2020),
}
EXPECTED_CORRELATIONS = [
    ("kilometer", "yearOfRegistration", -0.9, 0.0),
    ("yearOfRegistration", "price", 0.0, 0.9),
    ("kilometer", "price", -0.9, 0.0),
    ("power", "price", 0.0, 0.9),
]

# Serving-time frequency tables; a value outside them counts as UNSEEN_FREQUENCY.
UNSEEN_FREQUENCY = 0.005
SERVING_BRAND_FREQUENCY = {
    "volkswagen": 0.200091, "bmw": 0.113960, "mercedes-benz": 0.104804, "opel": 0.096641,
    "audi": 0.096032, "ford": 0.066154, "renault": 0.043726, "peugeot": 0.030603, "fiat": 0.024497,
    "seat": 0.019900, "skoda": 0.017669, "mazda": 0.016253, "smart": 0.015558, "citroen": 0.015180,
    "toyota": 0.014748, "nissan": 0.013821, "hyundai": 0.011259, "mini": 0.010954,
    "volvo": 0.009939, "mitsubishi": 0.008680,
}
SERVING_MODEL_FREQUENCY = {
    "golf": 0.082492, "3-series": 0.060646, "c-class": 0.037851, "a4": 0.036454, "corsa": 0.031765,
    "polo": 0.028268, "astra": 0.028048, "passat": 0.026612, "5-series": 0.024408, "focus": 0.022637,
    "e-class": 0.022289, "a3": 0.019615, "2-reihe": 0.018607, "a6": 0.018021, "transporter": 0.016307,
    "fiesta": 0.014207, "twingo": 0.013845, "fortwo": 0.013779, "punto": 0.013019, "a-class": 0.012424,
}

DISPLAY_NAMES = {
    "yearOfRegistration": "Registration Year", "kilometer": "Kilometers Driven",
    "power": "Horsepower (PS)", "vehicleType_suv": "Is SUV",
    "gearbox_automatic": "Has Automatic Gearbox", "vehicleType_convertible": "Is Convertible",
    "vehicleType_coupe": "Is Coupe", "vehicleType_sedan": "Is Sedan", "vehicleType_van": "Is Van",
    "vehicleType_station-wagon": "Is Station Wagon", "fuelType_diesel": "Diesel Fuel",
    "fuelType_gasoline": "Gasoline Fuel", "fuelType_hybrid": "Hybrid Fuel",
    "fuelType_electric": "Electric Fuel", "seller_private": "Private Seller",
    "brand_freq": "Brand Frequency", "model_freq": "Model Frequency", "vehicleAge": "Vehicle Age",
    "kmPerYear": "Km Per Year", "km_power_ratio": "Km/Power Ratio", "log_km": "Log Kilometers",
}

# Tokens a CSV reader of data frames treats as missing.
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Characters stripped from both ends of a text value (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Parameter values that the search of each classifier tries; None as depth is an unlimited tree.
PARAMETER_GRIDS = {
    "baseline": {},
    "random_forest": {"trees": [100, 200, 300], "depth": [None, 10, 20, 30], "min_split": [2, 5, 10]},
    "extra_trees": {"trees": [100, 200, 300], "depth": [None, 10, 20], "min_split": [2, 5, 10]},
    "log_reg": {"C": [10 ** (-2 + 3 * i / 4) for i in range(5)]},
    "decision_tree": {
        "depth": [None, 5, 10, 20, 30], "min_split": [2, 5, 10, 20], "min_leaf": [1, 2, 4, 8],
        "criterion": ["gini", "entropy"], "max_features": [None, "sqrt", "log2"],
    },
    "linear_svm": {"C": [10.0 ** i for i in range(-3, 3)], "loss": ["hinge", "squared_hinge"]},
    "boosted_trees": {"rounds": [200, 300, 500], "depth": [4, 6, 8], "rate": [0.01, 0.05, 0.1], "subsample": [0.8, 1.0]},
}
# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------
