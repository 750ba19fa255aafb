"""Field samples kept in a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.darwincore import sample_points

FIELD_COLUMNS = (
    "sample_id", "material_sample_id", "event_date", "sample_depth", "sample_size_frac",
    "sample_size", "sample_type_code", "lat", "lon",
)


def select_samples(
    samples: DataFrame, points: DataFrame, monitoring: str | None = None, mission: str | None = None
) -> DataFrame:
    """Samples of a site or campaign with their coordinates.

    The filters are plain column predicates on the scan, so a JDBC source evaluates them.
    """
    if monitoring:
        samples = samples.where(samples["monitoring_id"] == monitoring)
    if mission:
        samples = samples.where(samples["mission_id"] == mission)
    return sample_points(samples, points).select(*FIELD_COLUMNS)


def read_database(
    spark: SparkSession, url: str, monitoring: str | None = None, mission: str | None = None,
    **options: str,
) -> DataFrame:
    """The same over JDBC; geometry becomes two doubles in the database."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    samples = reader.option("dbtable", "sample_metadata").load()
    points = reader.option(
        "dbtable",
        "(SELECT material_sample_id, gis_point_location_type AS location_type, "
        "ST_Y(geom) AS lat, ST_X(geom) AS lon FROM gis_point) p",
    ).load()
    rows = select_samples(samples, points, monitoring, mission).orderBy("sample_id")
    if rows.isEmpty():
        raise ValueError(f"no samples for {monitoring or mission or 'the whole database'}")
    return rows
