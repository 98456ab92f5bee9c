"""The sensor registry that a new installation starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.schemas import SENSORS

# fixed values: sensor_id, lat, lon, city, zone
SEED = (
    ("CAP_001", 48.8566, 2.3522, "Paris", "urban_background"),
    ("CAP_002", 48.8606, 2.3376, "Paris", "traffic"),
    ("CAP_003", 48.8738, 2.2950, "Paris", "industrial"),
    ("CAP_004", 51.5074, -0.1278, "London", "urban_background"),
    ("CAP_005", 51.5155, -0.0922, "London", "traffic"),
    ("CAP_006", 52.5200, 13.4050, "Berlin", "urban_background"),
    ("CAP_007", 52.4800, 13.3900, "Berlin", "residential"),
    ("CAP_008", 41.9028, 12.4964, "Rome", "urban_background"),
    ("CAP_009", 41.8860, 12.5100, "Rome", "traffic"),
    ("CAP_010", 40.4168, -3.7038, "Madrid", "urban_background"),
    ("CAP_011", 40.4300, -3.6900, "Madrid", "industrial"),
    ("CAP_012", 50.0755, 14.4378, "Prague", "urban_background"),
    ("CAP_013", 48.2082, 16.3738, "Vienna", "urban_background"),
    ("CAP_014", 47.3769, 8.5417, "Zurich", "residential"),
    ("CAP_015", 50.8503, 4.3517, "Brussels", "urban_background"),
    ("CAP_016", 52.3676, 4.9041, "Amsterdam", "traffic"),
    ("CAP_017", 55.6761, 12.5683, "Copenhagen", "residential"),
    ("CAP_018", 59.9139, 10.7522, "Oslo", "urban_background"),
    ("CAP_019", 60.1699, 24.9384, "Helsinki", "residential"),
    ("CAP_020", 59.3293, 18.0686, "Stockholm", "urban_background"),
    ("CAP_021", 48.1351, 11.5820, "Munich", "traffic"),
    ("CAP_022", 53.5753, 10.0153, "Hamburg", "industrial"),
    ("CAP_023", 51.2217, 6.7762, "Dusseldorf", "traffic"),
    ("CAP_024", 53.0793, 8.8017, "Bremen", "residential"),
    ("CAP_025", 45.4642, 9.1900, "Milan", "industrial"),
    ("CAP_026", 45.0703, 7.6869, "Turin", "traffic"),
    ("CAP_027", 43.7102, 7.2620, "Nice", "urban_background"),
    ("CAP_028", 43.2965, 5.3698, "Marseille", "industrial"),
    ("CAP_029", 45.7640, 4.8357, "Lyon", "traffic"),
    ("CAP_030", 47.2184, -1.5536, "Nantes", "residential"),
    ("CAP_031", 51.4545, -2.5879, "Bristol", "urban_background"),
    ("CAP_032", 53.4808, -2.2426, "Manchester", "industrial"),
    ("CAP_033", 53.8008, -1.5491, "Leeds", "traffic"),
    ("CAP_034", 55.8642, -4.2518, "Glasgow", "urban_background"),
    ("CAP_035", 57.1497, -2.0943, "Aberdeen", "residential"),
    ("CAP_036", 50.7184, -3.5339, "Exeter", "residential"),
    ("CAP_037", 52.4862, -1.8904, "Birmingham", "industrial"),
    ("CAP_038", 53.7676, -0.3274, "Hull", "industrial"),
    ("CAP_039", 51.4816, -3.1791, "Cardiff", "urban_background"),
    ("CAP_040", 54.5973, -5.9301, "Belfast", "urban_background"),
    ("CAP_041", 48.5734, 7.7521, "Strasbourg", "traffic"),
    ("CAP_042", 43.6047, 1.4442, "Toulouse", "residential"),
    ("CAP_043", 44.8378, -0.5792, "Bordeaux", "urban_background"),
    ("CAP_044", 49.4431, 1.0993, "Rouen", "industrial"),
    ("CAP_045", 50.6292, 3.0573, "Lille", "traffic"),
    ("CAP_046", 46.2276, 2.2137, "Clermont", "residential"),
    ("CAP_047", 48.6921, 6.1844, "Nancy", "urban_background"),
    ("CAP_048", 47.3220, 5.0415, "Dijon", "residential"),
    ("CAP_049", 45.1885, 5.7245, "Grenoble", "industrial"),
    ("CAP_050", 43.1242, 5.9280, "Toulon", "urban_background"),
)


def seed_sensors(spark: SparkSession, rows=SEED) -> DataFrame:
    schema = "sensor_id string, lat double, lon double, city string, zone string"
    return spark.createDataFrame(list(rows), schema).withColumn("status", F.lit("active"))


def load_sensor_registry(existing: DataFrame, seed: DataFrame) -> DataFrame:
    """The registry after the seed was inserted; ids already there are left alone."""
    columns = [c for c in SENSORS.fieldNames() if c in seed.columns and c in existing.columns]
    fresh = seed.join(existing.select("sensor_id"), "sensor_id", "left_anti")
    return existing.select(*columns).unionByName(fresh.select(*columns))
