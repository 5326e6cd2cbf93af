"""Schemas, category domains and other fixed values."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


TYPE_OF = {
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "boolean": BooleanType(),
    "string": StringType(),
}


def _schema(columns: str) -> StructType:
    """Flat schema from ``name type`` pairs; needs no session, unlike DDL parsing."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, TYPE_OF[kind]) for name, kind in pairs])


# ---------------------------------------------------------------- fixed values
# Column names and their order are the file contracts.

RAW_SCHEMA = StructType(
    [
        StructField("Date", DateType()),
        StructField("Area Name", StringType()),
        StructField("Road/Intersection Name", StringType()),
        *[
            StructField(name, DoubleType())
            for name in (
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
            )
        ],
        StructField("Weather Conditions", StringType()),
        StructField("Roadwork and Construction Activity", StringType()),
    ]
)

STANDARD_SCHEMA = _schema(
    "date date, area string, road_intersection string, traffic_volume double, average_speed double, "
    "travel_time_index double, congestion_level double, congestion_class string, weather string, "
    "roadwork string, day_of_week int, day_type string"
)

TAGGED_SCHEMA = StructType([*STANDARD_SCHEMA.fields, StructField("corridor", StringType())])

CALENDAR_SCHEMA = _schema(
    "date date, festival_name string, festival_flag boolean, holiday_flag boolean, source string"
)

INTEGRATED_SCHEMA = _schema(
    "date date, area string, road_intersection string, corridor string, traffic_volume double, "
    "average_speed double, travel_time_index double, congestion_level double, congestion_class string, "
    "weather string, roadwork string, day_of_week int, day_type string, festival_flag boolean, "
    "festival_name string, holiday_flag boolean"
)

STAGE_BY_MONTH_SCHEMA = StructType([*INTEGRATED_SCHEMA.fields, StructField("year_month", StringType())])

ADVISORY_COLUMNS = [
    "date",
    "corridor",
    "area",
    "road_intersection",
    "congestion_class",
    "festival_flag",
    "festival_name",
    "holiday_flag",
    "weather",
    "roadwork",
    "advisory_level",
    "recommendation",
    "personnel_action",
    "diversion_action",
    "roadwork_action",
    "context_notes",
]

PREDICTED_ADVISORY_COLUMNS = [
    *ADVISORY_COLUMNS[:4],
    "actual_congestion_class",
    "predicted_congestion_class",
    *ADVISORY_COLUMNS[5:],
]

# Response of a routing provider, and of a place search.
ROUTES_TYPE = (
    "array<struct<distance: variant, duration: variant, "
    "legs: array<struct<summary: string, steps: array<struct<name: string>>>>, "
    "geometry: struct<coordinates: array<array<double>>>>>"
)
ROUTE_RESPONSE_SCHEMA = f"code string, routes {ROUTES_TYPE}"
PLACE_RESULTS_SCHEMA = "array<struct<lat: string, lon: string, display_name: string>>"

CLASSES = ["Low", "Medium", "High"]
CLASSES_ALPHABETIC = ["High", "Low", "Medium"]
ADVISORY_LEVELS = ["Normal", "Moderate", "High"]
ADVERSE_WEATHER = ["Rain", "Fog"]
WEEKEND_DAYS = [1, 7]
LOW_BELOW = 60.0
MEDIUM_BELOW = 90.0
CORRIDOR_SEPARATOR = " | "

NUMERIC_FEATURES = ["traffic_volume", "average_speed", "travel_time_index", "day_of_week"]
CATEGORICAL_FEATURES = ["corridor", "area", "road_intersection", "weather", "roadwork", "day_type"]
BOOLEAN_FEATURES = ["festival_flag", "holiday_flag"]
FEATURES = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, *BOOLEAN_FEATURES]
TARGET = "congestion_class"

# Why a column of the integrated table is not a model feature.
EXCLUDED_FEATURES = {
    "congestion_level": "leaks the target: the class is derived from it",
    "congestion_class": "the target itself",
    "festival_name": "sparse label, already covered by festival_flag",
    "date": "raw identifier; only derived calendar fields are used",
}

FEATURE_CANDIDATES = {
    "numeric": [
        "traffic_volume",
        "average_speed",
        "travel_time_index",
        "congestion_level",
        "road_capacity_utilization",
        "incident_reports",
        "environmental_impact",
        "public_transport_usage",
        "traffic_signal_compliance",
        "parking_usage",
        "pedestrian_and_cyclist_count",
    ],
    "categorical": CATEGORICAL_FEATURES,
    "temporal": ["day_of_week", *BOOLEAN_FEATURES],
}

# What the integrated table is known not to offer; the first ones are numeric candidates as well.
UNAVAILABLE_FEATURES = [
    *FEATURE_CANDIDATES["numeric"][4:],
    "hour",
    "direction",
    "GPS coordinates",
    "live traffic features",
    "FASTag features",
    "signal-event features",
]

METRIC_NAMES = ["Accuracy", "Weighted Precision", "Weighted Recall", "F1 Score"]

# Advisory wording, one action set per congestion class.
ADVISORY_RULES = {
    "Low": {
        "advisory_level": "Normal",
        "recommendation": "Normal traffic management; continue routine monitoring.",
        "personnel_action": "Routine traffic personnel",
        "diversion_action": "No special diversion recommended",
        "roadwork_action": "No special roadwork restriction recommended",
    },
    "Medium": {
        "advisory_level": "Moderate",
        "recommendation": "Increase traffic monitoring and consider additional personnel at the affected corridor.",
        "personnel_action": "Consider additional traffic personnel",
        "diversion_action": "Consider diversion planning if congestion persists",
        "roadwork_action": "Review non-essential roadwork scheduling",
    },
    "High": {
        "advisory_level": "High",
        "recommendation": "Deploy additional traffic personnel and prepare diversion measures for the affected corridor.",
        "personnel_action": "Additional traffic personnel recommended",
        "diversion_action": "Prepare/activate suitable diversion planning",
        "roadwork_action": "Suspend or reschedule non-essential roadwork where operationally appropriate",
    },
}
ACTION_COLUMNS = list(ADVISORY_RULES["Low"])

# Context sentences, in output order.
CONTEXT_NOTES = {
    "festival": "Festival-related traffic conditions detected; strengthen traffic management preparedness.",
    "holiday": "Holiday-related traffic conditions detected; review expected travel demand.",
    "roadwork": "Roadwork is present; review whether it can be postponed during high-congestion periods.",
    "weather": "Adverse weather is present; consider additional caution and traffic monitoring.",
}

# Illustrative delay multiplier per class.
DELAY_MULTIPLIER = {"Low": 1.1, "Medium": 1.5, "High": 2.1}

# Which raw columns become which standard columns; the other raw columns are dropped.
RAW_TO_STANDARD = {
    "Date": "date",
    "Area Name": "area",
    "Road/Intersection Name": "road_intersection",
    "Traffic Volume": "traffic_volume",
    "Average Speed": "average_speed",
    "Travel Time Index": "travel_time_index",
    "Congestion Level": "congestion_level",
    "Weather Conditions": "weather",
    "Roadwork and Construction Activity": "roadwork",
}
# ------------------------------------------------------------ end fixed values

INTEGRATED_COLUMNS = INTEGRATED_SCHEMA.names
NUMERIC_MEASURES = ["traffic_volume", "average_speed", "travel_time_index", "congestion_level"]

# ---------------------------------------------------------------- fixed values
# Route texts, as format_string patterns.
ROUTE_TEXT = {
    "only_reason": "Only one route was returned by the routing service via %s. Estimated duration: %s (%.1f km).",
    "only_rationale": "**Available Route**: **%s** (%s, %.1f km). Only one route was returned by the routing service.",
    "faster_reason": "Recommended because it has the lowest estimated routing duration among the returned "
    "alternatives (saves ~%d min vs alternative via %s).",
    "faster_rationale": "**Recommended Route**: **%s**. Recommended because it has the lowest estimated routing "
    "duration (**%s**, %.1f km) among the returned alternatives, saving approximately **%d minutes** compared to "
    "the next alternative (**%s**, %s).",
    "shorter_reason": "Recommended because it offers the optimal balance of estimated duration (%s) and shorter "
    "travel distance (%.1f km).",
    "shorter_rationale": "**Recommended Route**: **%s**. Estimated durations are comparable; recommended for shorter "
    "travel distance (**%.1f km** vs %.1f km on **%s**).",
    "alternative_reason": "Alternative route via %s (+%d min, %+.1f km vs Recommended).",
    "none_rationale": "No routes available to evaluate.",
}
ROUTE_STATUS = ["Recommended", "Alternative", "Available Route"]
DURATION_BASIS = "osrm_road_network_estimate"

# Status of a request's answer by error code, and the message that goes with a code alone.
REQUEST_STATUS = {
    "INVALID_ORIGIN_COORDINATES": 422,
    "INVALID_DESTINATION_COORDINATES": 422,
    "EMPTY_ORIGIN": 422,
    "EMPTY_DESTINATION": 422,
    "SAME_PLACE": 422,
    "LOCATION_NOT_FOUND": 404,
    "ROUTE_NOT_FOUND": 404,
    "GEOCODING_TIMEOUT": 504,
    "OSRM_TIMEOUT": 504,
    "GEOCODING_SERVICE_ERROR": 502,
    "INVALID_GEOCODING_RESPONSE": 502,
    "OSRM_SERVICE_ERROR": 502,
    "INVALID_ROUTING_RESPONSE": 502,
}
REQUEST_MESSAGE = {
    "INVALID_ORIGIN_COORDINATES": "Origin latitude and longitude must be provided together.",
    "INVALID_DESTINATION_COORDINATES": "Destination latitude and longitude must be provided together.",
    "EMPTY_ORIGIN": "Origin must not be empty.",
    "EMPTY_DESTINATION": "Destination must not be empty.",
    "SAME_PLACE": "Origin and destination must be different places.",
    "INVALID_GEOCODING_RESPONSE": "Nominatim returned invalid location coordinates.",
    "ROUTE_NOT_FOUND": "OSRM returned no drivable routes.",
}
# What is said about a route response, by the problem found in it.
ROUTING_MESSAGE = {
    "INVALID_RESPONSE": "OSRM returned an invalid routing response.",
    "MISSING_ROUTES": "OSRM response is missing a valid routes list.",
    "UNREADABLE_ROUTE": "OSRM returned route data that could not be parsed.",
    "INVALID_DISTANCE": "OSRM returned an invalid route distance.",
    "INVALID_DURATION": "OSRM returned an invalid route duration.",
    "TOO_FEW_POINTS": "OSRM returned route geometry with fewer than two points.",
    "INVALID_COORDINATES": "OSRM returned invalid route coordinates.",
}
# Parts of a provider's message, in lower case, that tell what went wrong.
TIMEOUT_MARKS = ["timed out", "timeout"]
MISSING_MARKS = {
    "geocoding": ["could not be resolved", "not found"],
    "routing": ["no route", "noroute", "no drivable routes"],
}
PROVIDER_CODES = {
    "geocoding": ("GEOCODING_TIMEOUT", "LOCATION_NOT_FOUND", "GEOCODING_SERVICE_ERROR"),
    "routing": ("OSRM_TIMEOUT", "ROUTE_NOT_FOUND", "OSRM_SERVICE_ERROR"),
}
CITY_SPELLINGS = ["bengaluru", "bangalore"]
CITY_SUFFIX = ", Bengaluru, Karnataka, India"
HINT_SUFFIX = ", Bengaluru"
# ------------------------------------------------------------ end fixed values
