"""Names and numbers the engine shares with existing data sets."""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
# These must stay as they are: they are the names and numbers that existing
# weather grids, market series and published tables use.

KELVIN_ZERO = 273.15

# Accepted value-column names per physical variable, in order of preference.
VARIABLE_ALIASES = {
    "tmax": ("mx2t", "t2mmax", "tasmax", "tmax"),
    "tmin": ("mn2t", "t2mmin", "tasmin", "tmin"),
    "precip": ("tp", "precip", "pr", "total_precipitation"),
    "evap": ("e", "evspsbl", "evspsblsoi", "evaporation"),
    "soil": ("swvl1", "volumetric_soil_water_layer_1", "soil_moisture"),
    "u_wind": ("u10", "uas", "10m_u_component_of_wind"),
    "v_wind": ("v10", "vas", "10m_v_component_of_wind"),
}

# Kind of observations that a request means unless it names another.
DEFAULT_PRODUCT = "reanalysis"

# Folder of each physical variable below the base path of the index run.
INPUT_FOLDERS = {
    "tmax": "era5_max_2m_temperature",
    "tmin": "era5_min_2m_temperature",
    "precip": "total_precipitation",
    "evap": "evaporation",
    "soil": "volumetric_soil_water_layer_1",
    "u_wind": "10m_u_component_of_wind_mean",
    "v_wind": "10m_v_component_of_wind_mean",
}

INDEX_NAMES = (
    "GDD",
    "SPI",
    "SoilMoistureAnomaly",
    "EvapotranspirationRatio",
    "HeatwaveIndex",
    "WindSpeed",
)

INDEX_ATTRIBUTES = {
    "GDD": {"long_name": "Growing Degree Days", "units": "degree C day",
            "base_temperature_C": 10},
    "SPI": {"long_name": "Standardized Precipitation Index",
            "units": "dimensionless", "window_days": 30},
    "SoilMoistureAnomaly": {"long_name": "Soil Moisture Anomaly",
                            "units": "dimensionless"},
    "EvapotranspirationRatio": {"long_name": "Evapotranspiration Ratio (E/P)",
                                "units": "dimensionless",
                                "min_precip_threshold": 1e-4},
    "HeatwaveIndex": {"long_name": "Heatwave Index (count of days in 7-day "
                                   "window with Tmax > 35 C)",
                      "units": "1", "threshold_C": 35, "window_days": 7},
    "WindSpeed": {"long_name": "Wind Speed Magnitude", "units": "m s-1"},
}

# Wheat-belt states of the weekly predictor table.
BELT_STATES = ("CO", "ID", "IL", "KS", "MN", "MT",
               "ND", "NE", "OK", "SD", "TX", "WA")

# Belt minimum / maximum are only defined for these indices.
BELT_MIN_INDICES = ("SPI", "SoilMoistureAnomaly")
BELT_MAX_INDICES = ("HeatwaveIndex", "GDD")

# Quarterly supply-and-use columns: amounts that accrue over the quarter ...
SUPPLY_FLOWS = (
    "US_Production_M_Bu",
    "US_Imports_M_Bu",
    "US_Food_Use_M_Bu",
    "US_Seed_Use_M_Bu",
    "US_Feed_Residual_Use_M_Bu",
    "US_Total_Domestic_Use_M_Bu",
    "US_Exports_M_Bu",
    "US_Total_Disappearance_M_Bu",
)
# ... and amounts that hold at a point in time.
SUPPLY_LEVELS = (
    "US_Beginning_Stocks_M_Bu",
    "US_Ending_Stocks_M_Bu",
    "US_Total_Supply_M_Bu",
)

ANNUAL_SUPPLY = (
    "US_Planted_Acreage_M_Acres",
    "US_Harvested_Acreage_M_Acres",
    "US_Production_M_Bu",
    "US_Yield_Bu_Acre",
    "US_Farm_Price_USD_Bu",
)

COMMODITY_PRICES = ("DAP", "TSP", "Urea", "Crude_oil_WTI")
MACRO_SERIES = ("CPIAUCSL", "PPIACO", "UNRATE", "GDPC1")
RISK_SERIES = ("GPR",)
MARKET_SERIES = ("ZW=F", "^TNX", "DX-Y.NYB")
FARM_PRICE = "Price_USD_per_Bushel"
TARGET_SERIES = "ZW=F"

# First and last day of the weekly predictor table.
PREDICTOR_START = "2010-01-01"
PREDICTOR_END = "2025-03-31"

# --- End of fixed values ----------------------------------------------------

# Columns of the canonical cube.
CELL = ("lat_i", "lon_i")
CUBE_COORDS = ("date", "lat_i", "lon_i", "lat", "lon")
