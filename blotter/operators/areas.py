"""Metrics joined to area polygons on the normalised area key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def area_map_geo(metrics: DataFrame, dim: DataFrame) -> DataFrame:
    """Left join: every metric row is kept; ``geojson`` is null without a polygon.

    Of several polygons with one key the first by (name, text) is taken, so a metric row
    is never doubled. Both sides then hold one row per area; AQE picks the join.
    """
    first = F.min(F.struct(F.coalesce("area_name", F.lit("")).alias("n"),
                           F.coalesce("geojson", F.lit("")).alias("g"), "area_name", "geojson"))
    geo = (dim.groupBy(F.col("area_id").alias("area_id_norm")).agg(first.alias("f"))
           .select("area_id_norm", F.col("f.area_name").alias("geo_area_name"), F.col("f.geojson")))
    return (metrics.withColumn("area_id_norm", C.area_key("area_id"))
                   .join(geo, "area_id_norm", "left"))
