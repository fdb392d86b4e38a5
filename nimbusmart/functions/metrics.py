"""Metric dictionary and mart rules.

FIXED VALUES — these must equal the reference product's for results to match:
metric column names, the three mart rule lists (column, aggregate) in their
natural order, the grouping keys, and the display label of each metric.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
MART_KEYS = ["year", "country", "region", "city_name"]

METRIC_COLUMNS = [
    "avg_temp_c",
    "min_temp_c",
    "max_temp_c",
    "precipitation_mm",
    "snow_depth_mm",
    "avg_wind_dir_deg",
    "avg_wind_speed_kmh",
    "peak_wind_gust_kmh",
    "avg_sea_level_pres_hpa",
    "sunshine_total_min",
]

RISK_RULES = [
    ("avg_temp_c", "avg"),
    ("min_temp_c", "min"),
    ("max_temp_c", "max"),
    ("precipitation_mm", "sum"),
    ("snow_depth_mm", "avg"),
    ("avg_wind_dir_deg", "avg"),
    ("avg_wind_speed_kmh", "avg"),
    ("peak_wind_gust_kmh", "max"),
    ("avg_sea_level_pres_hpa", "avg"),
    ("sunshine_total_min", "sum"),
]

TOURISM_RULES = [
    ("avg_temp_c", "avg"),
    ("min_temp_c", "min"),
    ("max_temp_c", "max"),
    ("precipitation_mm", "sum"),
    ("snow_depth_mm", "avg"),
    ("avg_wind_speed_kmh", "avg"),
    ("sunshine_total_min", "sum"),
]

AGRI_RULES = [
    ("avg_temp_c", "avg"),
    ("min_temp_c", "min"),
    ("max_temp_c", "max"),
    ("precipitation_mm", "sum"),
    ("sunshine_total_min", "sum"),
]

METRIC_LABELS = {
    "avg_temp_c": "Température Moyenne (°C)",
    "min_temp_c": "Température Minimum (°C)",
    "max_temp_c": "Température Maximum (°C)",
    "precipitation_mm": "Précipitations (mm)",
    "snow_depth_mm": "Épaisseur de Neige (mm)",
    "avg_wind_dir_deg": "Direction du Vent Moyenne (°)",
    "avg_wind_speed_kmh": "Vitesse du Vent Moyenne (km/h)",
    "peak_wind_gust_kmh": "Rafales de Vent Max (km/h)",
    "avg_sea_level_pres_hpa": "Pression Niveaux Mer (hPa)",
    "sunshine_total_min": "Ensoleillement Total (min)",
}

# Bronze drops these technical columns after the geo join.
TECHNICAL_COLUMNS = ["iso2", "iso3", "station_id", "__index_level_0__"]
# Silver drops rows missing any of these.
REQUIRED_COLUMNS = ["date", "city_name", "year"]
# ---------------------------------------------------------------------------

MARTS = {
    "dm_risks": RISK_RULES,
    "dm_tourism": TOURISM_RULES,
    "dm_agriculture": AGRI_RULES,
}

AGGREGATES = ("avg", "min", "max", "sum")


def label_of(metric: str) -> str:
    """Display label of a metric; unknown metrics keep their raw name."""
    return METRIC_LABELS.get(metric, metric)


def metric_of(label: str, available: list[str]) -> str:
    """Reverse lookup: the first available metric whose label is ``label``."""
    for m in available:
        if label_of(m) == label:
            return m
    raise KeyError(f"no metric with label {label!r} among {available}")


def metrics_of(columns: list[str]) -> list[str]:
    """Metric discovery: every column that is not a mart key."""
    return [c for c in columns if c not in MART_KEYS]
