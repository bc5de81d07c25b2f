"""Column names and lists that the data files use.

Fixed values: the spellings and their order are part of the file formats.
"""

DATE = "Date"
WEATHER_DATE = "datetime"
AREA = "Area Name"
ROAD = "Road/Intersection Name"
WEATHER = "Weather Conditions"
ROADWORK = "Roadwork and Construction Activity"
VOLUME = "Traffic Volume"
DAY_OF_WEEK = "day_of_week"
IS_HOLIDAY = "is_holiday"
DAYLIGHT = "minutes_of_daylight"

# The eleven measurements of a traffic row, in file order.
MEASURES = [
    "Traffic Volume",
    "Average Speed",
    "Travel Time Index",
    "Congestion Level",
    "Road Capacity Utilization",
    "Incident Reports",
    "Environmental Impact",
    "Public Transport Usage",
    "Traffic Signal Compliance",
    "Parking Usage",
    "Pedestrian and Cyclist Count",
]

# The fifteen weather columns joined onto traffic rows.
WEATHER_FEATURES = [
    "tempmax", "tempmin", "feelslikemax", "feelslikemin", "dew", "humidity", "precip", "precipcover",
    "windgust", "windspeed", "winddir", "cloudcover", "visibility", "solarradiation", "uvindex",
]

# The nineteen weather columns whose correlations are reported.
WEATHER_CORRELATES = [
    "tempmax", "tempmin", "temp", "feelslikemax", "feelslikemin", "dew", "humidity", "precip", "precipcover",
    "windgust", "windspeed", "winddir", "sealevelpressure", "cloudcover", "visibility", "solarradiation",
    "solarenergy", "uvindex", "severerisk",
]

DIRECT_FEATURES = MEASURES + [ROADWORK]
CYCLE_FEATURES = ["day_of_week_sin", "day_of_week_cos", "day_of_year_sin", "day_of_year_cos"]
CATEGORICALS = [WEATHER, AREA, ROAD]
CATEGORY_PREFIXES = [c + "_" for c in CATEGORICALS]
FLAGS = [IS_HOLIDAY, ROADWORK]

# Two overlapping weather exports are cut here; the split of the models is by calendar year.
STITCH_CUTOFF = "2023-07-01"
SPLIT_YEARS = {"train": 2022, "val": 2023, "test": 2024}
