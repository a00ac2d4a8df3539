"""Table schemas, feature lists and the fixed rule values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

INT, LONG, DBL = T.IntegerType(), T.LongType(), T.DoubleType()
STR, BOOL, NTZ = T.StringType(), T.BooleanType(), T.TimestampNTZType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


ZONE = "PULocationID"
WINDOW = "pickup_window"
DEMAND = "actual_demand"

TRIPS = table(tpep_pickup_datetime=NTZ, tpep_dropoff_datetime=NTZ, PULocationID=INT, trip_distance=DBL)

DEMAND_TABLE = table(pickup_window=NTZ, PULocationID=INT, actual_demand=LONG, hour=INT, day_of_week=INT, month=INT)

CALENDAR_FEATURES = [
    "is_weekend", "is_rush_hour", "day_of_month", "week_of_year", "time_of_day", "season", "is_manhattan",
]
LAGS = (1, 4, 24, 96, 672)
ROLLING_FEATURES = ["rolling_mean_4", "rolling_std_4", "rolling_max_24", "rolling_min_24"]


def lag_features(lags=LAGS) -> list[str]:
    return [f"lag_{n}" for n in lags]


def model_features(lags=LAGS) -> list[str]:
    """Model input columns, in model order."""
    return [ZONE, "hour", "day_of_week", "month", *CALENDAR_FEATURES, *lag_features(lags), *ROLLING_FEATURES]


FEATURES = model_features()
COMPARISON_FEATURES = [ZONE, "hour", "day_of_week", "month", "lag_1", "lag_4", "lag_96", "rolling_mean_4"]

# Zone ids counted as Manhattan.
MANHATTAN_ZONES = [
    4, 12, 13, 24, 41, 42, 43, 45, 48, 50, 68, 74, 75, 79, 87, 88, 90, 100, 103, 104, 105, 107, 113, 114, 116,
    120, 125, 127, 128, 137, 140, 141, 142, 143, 144, 148, 151, 152, 153, 158, 161, 162, 163, 164, 166, 170,
    186, 194, 202, 209, 211, 224, 229, 230, 231, 232, 233, 234, 236, 237, 238, 239, 243, 244, 246, 249, 261,
    262, 263,
]

# Named zones with coordinates (zone id, latitude, longitude, name), by zone id.
NAMED_ZONES = [
    (68, 40.7484, -73.9857, "East Village"),
    (87, 40.7589, -73.9851, "Financial District North"),
    (88, 40.7071, -74.0134, "Financial District South"),
    (90, 40.7484, -73.9857, "Flatiron"),
    (100, 40.7589, -73.9851, "Garment District"),
    (107, 40.7589, -73.9851, "Greenwich Village North"),
    (125, 40.8448, -73.9379, "Harlem"),
    (132, 40.6437, -73.7823, "JFK Airport"),
    (138, 40.7769, -73.9087, "LaGuardia Airport"),
    (144, 40.7484, -73.9857, "Little Italy"),
    (148, 40.7589, -73.9851, "Lower East Side"),
    (158, 40.7484, -73.9857, "Midtown Center"),
    (161, 40.7589, -73.9851, "Midtown East"),
    (162, 40.7614, -73.9776, "Midtown North"),
    (163, 40.7589, -73.9851, "Midtown South"),
    (170, 40.7284, -73.9942, "Penn Station"),
    (211, 40.7484, -73.9857, "Times Square"),
    (224, 40.7589, -73.9851, "Tribeca"),
    (230, 40.7589, -73.9851, "UN/Turtle Bay South"),
    (231, 40.8020, -73.9665, "Union Square"),
    (232, 40.7789, -73.9692, "Upper East Side North"),
    (233, 40.7677, -73.9628, "Upper East Side South"),
    (234, 40.7945, -73.9686, "Upper West Side North"),
    (237, 40.7869, -73.9754, "Upper West Side South"),
]
ZONE_TABLE = table(PULocationID=INT, lat=DBL, lon=DBL, name=STR)


def zone_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NAMED_ZONES, ZONE_TABLE)


# Accepted range of every request field; None means unbounded.
REQUEST_RANGES: dict[str, tuple[float, float | None]] = {
    "PULocationID": (1, 263), "hour": (0, 23), "day_of_week": (0, 6), "month": (1, 12),
    "is_weekend": (0, 1), "is_rush_hour": (0, 1), "day_of_month": (1, 31), "week_of_year": (1, 53),
    "time_of_day": (0, 3), "season": (0, 3), "is_manhattan": (0, 1),
    "lag_1": (0, None), "lag_4": (0, None), "lag_24": (0, None), "lag_96": (0, None), "lag_672": (0, None),
    "rolling_mean_4": (0, None), "rolling_std_4": (0, None), "rolling_max_24": (0, None), "rolling_min_24": (0, None),
}

# Columns covered by the row quality rules and their accepted ranges.
QUALITY_RANGES: dict[str, tuple[float, float | None]] = {
    "PULocationID": (1, 263), "hour": (0, 23), "day_of_week": (0, 6), "month": (1, 12),
    "lag_1": (0, None), "lag_4": (0, None), "lag_96": (0, None), "rolling_mean_4": (0, None),
}

# Fixed values: (mean, standard deviation) used by the z-score rule, and its limit.
QUALITY_Z_STATS: dict[str, tuple[float, float]] = {
    "lag_1": (15.0, 10.0), "lag_4": (15.5, 10.5), "lag_96": (16.0, 11.0), "rolling_mean_4": (15.5, 10.0),
}
QUALITY_MAX_Z = 5.0

# Upper bounds of the cumulative histograms.
LATENCY_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
VALUE_BOUNDS = [0.0, 5.0, 10.0, 15.0, 20.0, 25.0, 30.0, 40.0, 50.0, 75.0, 100.0, 150.0, 200.0]
BATCH_SIZE_BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0]

PREDICTION_LOG = table(
    id=LONG, timestamp=NTZ, location_id=INT, hour=INT, day_of_week=INT, month=INT,
    lag_1=DBL, lag_4=DBL, lag_96=DBL, rolling_mean_4=DBL, predicted_demand=DBL, actual_demand=DBL,
    error=DBL, latency_ms=DBL, model_version=STR, endpoint=STR, created_at=NTZ,
)
DRIFT_LOG = table(
    id=LONG, timestamp=NTZ, report_type=STR, drift_detected=BOOL, drift_score=DBL,
    features_affected=T.ArrayType(STR), report_json=STR, created_at=NTZ,
)
METRIC_LOG = table(
    id=LONG, timestamp=NTZ, metric_name=STR, metric_value=DBL, model_version=STR, data_window=STR, created_at=NTZ,
)
API_LOG = table(
    id=LONG, timestamp=NTZ, endpoint=STR, status_code=INT, latency_ms=DBL, error_message=STR, created_at=NTZ,
)

MODEL_REGISTRY = table(
    version=STR, trained_at=STR, model_path=STR,
    performance=table(mae=DBL, rmse=DBL, r2=DBL, mape=DBL),
    training_data=table(start_date=STR, end_date=STR, n_samples=LONG),
    is_deployed=BOOL, deployed_at=STR,
)

FEATURE_DRIFT = table(
    feature=STR, drift_detected=BOOL, test=STR, drift_score=DBL, p_value=DBL, reference_mean=DBL,
    production_mean=DBL, mean_shift=DBL, reference_std=DBL, production_std=DBL,
)
PREDICTION_DRIFT = table(mean=DBL, std=DBL, min=DBL, max=DBL, median=DBL,
                         performance=table(mae=DBL, rmse=DBL, mape=DBL, bias=DBL))
DRIFT_REPORT = table(
    timestamp=STR,
    summary=table(total_features=LONG, drifted_features=LONG, drift_detected=BOOL,
                  drifted_feature_names=T.ArrayType(STR)),
    feature_drift=T.ArrayType(FEATURE_DRIFT),
    prediction_drift=PREDICTION_DRIFT,
    production_data_size=LONG,
)
CHECK_REPORT = table(
    timestamp=STR, config=table(days_back=INT, end_date=STR, dry_run=BOOL, force_retrain=BOOL, reference_days=INT),
    status=STR, actions_taken=T.ArrayType(STR), production_data_records=LONG,
    performance_metrics=table(mae=DBL, rmse=DBL, r2=DBL, mae_increase_pct=DBL, samples=LONG),
    drift_summary=table(total_features=LONG, drifted_features=LONG, drift_detected=BOOL,
                        drifted_feature_names=T.ArrayType(STR)),
    should_retrain=BOOL, retrain_reasons=STR, new_model_version=STR,
    model_comparison=table(champion_mae=DBL, challenger_mae=DBL, winner=STR, mae_improvement_pct=DBL),
    error=STR,
)
