"""Proximity, bounding box, centroid and map weights.

The nearest-station search has one origin: its coordinates are fetched with a
scalar subquery (exactly one row, by a unique key) and every station's distance
is a column expression over one scan of the station dimension. No pairs are
formed; the work is linear in the number of stations. ``nearest_all`` answers for
every station at once, by grid cells.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.functions.geo import haversine_km
from urbanlens.session import land


def nearest(stations: DataFrame, origin_key: str, n: int = 10, key: str = "station_key") -> DataFrame:
    """The ``n`` stations nearest to the origin, itself and NULL coordinates excluded (P29);
    the origin is a scalar subquery (J14) and ``rank`` numbers the result (W06).

    Ordered by the unrounded distance, then key (Q19); distance is rounded to
    2 dp only in the output.
    """
    origin = stations.filter(F.col(key) == origin_key)
    lat0 = origin.select(F.col("latitude").cast("double")).scalar()
    lon0 = origin.select(F.col("longitude").cast("double")).scalar()
    cand = stations.filter((F.col(key) != origin_key) & F.col("latitude").isNotNull()
                           & F.col("longitude").isNotNull())
    d = haversine_km(lat0, lon0, F.col("latitude"), F.col("longitude"))
    w = Window.orderBy("_d", key)
    return (cand.withColumn("_d", d).filter(F.col("_d").isNotNull())
            .orderBy("_d", key).limit(n)
            .withColumn("rank", F.row_number().over(w))
            .withColumn("distance_km", F.round("_d", 2)).drop("_d"))


def nearest_many(stations: DataFrame, origin_keys: list[str], n: int = 10,
                 key: str = "station_key") -> DataFrame:
    """J13 for a short list of origins (a comparison picks up to three): one pass over the
    stations. The origins' coordinates are one scalar subquery; each station yields a row
    per origin, and the ranking keeps ``n`` rows per origin in each task before its shuffle."""
    point = F.struct(F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    origins = stations.filter(F.col(key).isin(list(origin_keys))).agg(
        F.collect_list(F.struct(F.col(key).alias("origin_key"), point.alias("at"))).alias("o")).scalar()
    cand = (stations.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .select("*", F.explode(origins).alias("_o")).filter(F.col(key) != F.col("_o.origin_key")))
    d = haversine_km(F.col("_o.at.lat"), F.col("_o.at.lon"), F.col("latitude"), F.col("longitude"))
    w = Window.partitionBy("origin_key").orderBy("_d", key)
    return (cand.withColumn("_d", d).filter(F.col("_d").isNotNull()).withColumn("origin_key", F.col("_o.origin_key"))
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .withColumn("distance_km", F.round("_d", 2)).drop("_d", "_o"))


FINEST = 15  # cells of 360 / 2^15 degrees, about 1.2 km


def nearest_all(stations: DataFrame, n: int = 10, key: str = "station_key", finest: int = FINEST) -> DataFrame:
    """J13/T07 for every station: ``origin_key, rank, station_key, distance_km``.

    Stations meet by grid cell, an equi-join of each origin's 3 x 3 cells with the cells of
    all stations. Whoever has ``n`` neighbours nearer than anything outside those cells can
    be is done; the others go on with cells of twice the size, until one cell is the globe,
    so the result is exact (across 180 degrees and near the poles too). Each round is
    written, and holds only what the round before left open.

    Stations without coordinates or key take no part. Of stations in one place only the
    first ``n + 1`` by key can be among anyone's ``n`` nearest; the others are origins only.
    """
    spark = stations.sparkSession
    at = stations.select(F.col(key).alias("k"), F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    at = spark.read.parquet(land(at.filter("k is not null and lat is not null and lon is not null"), "stations"))
    in_place = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("k"))
    others = at.withColumn("_n", in_place).filter(F.col("_n") <= n + 1).select(
        F.col("k").alias("ok"), F.col("lat").alias("olat"), F.col("lon").alias("olon"))
    left, found = at, None
    for level in range(finest, -1, -1):
        size, columns = 360 / 2 ** level, 2 ** level
        cell = lambda lat, lon: (F.pmod(F.floor((F.col(lon) + 180) / size), F.lit(columns)), F.floor((F.col(lat) + 90) / size))
        cx, cy = cell("lat", "lon")
        steps = F.array(*[F.lit(i) for i in ((-1, 0, 1) if columns > 2 else range(columns))])
        asked = (left.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
                 .select("k", "lat", "lon", F.pmod(cx + F.col("dx"), F.lit(columns)).alias("cx"), (cy + F.col("dy")).alias("cy")))
        ox, oy = cell("olat", "olon")
        near = (asked.join(others.withColumn("cx", ox).withColumn("cy", oy), ["cx", "cy"]).filter(F.col("k") != F.col("ok"))
                .withColumn("d", haversine_km("lat", "lon", "olat", "olon"))
                .withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("d", "ok"))).filter(F.col("rank") <= n))
        per_origin = near.groupBy("k", "lat").agg(F.collect_list(F.struct("rank", "ok", "d")).alias("best"), F.max("d").alias("far"))
        # the nearest that anything outside the cells can be: past a parallel, or past a meridian
        beside = F.asin(F.cos(F.radians("lat")) * math.sin(math.radians(min(size, 90))))
        reach = F.least(F.lit(math.radians(size)), beside) * C.EARTH_RADIUS_KM
        sure = F.lit(level == 0) | ((F.size("best") >= n) & (F.col("far") < reach))
        done = spark.read.parquet(land(per_origin.filter(sure).select("k", "best"), "nearest"))
        found = done if found is None else found.unionByName(done)
        if level:
            left = spark.read.parquet(land(left.join(done.select("k"), "k", "left_anti"), "stations"))
            if left.isEmpty():
                break
    return found.select(F.col("k").alias("origin_key"), F.explode("best").alias("b")).select(
        "origin_key", F.col("b.rank").alias("rank"), F.col("b.ok").alias("station_key"), F.round("b.d", 2).alias("distance_km"))


def nearby_weight(nearby: DataFrame, lo: float = C.NEARBY_WEIGHT_RANGE[0],
                  hi: float = C.NEARBY_WEIGHT_RANGE[1]) -> DataFrame:
    """Weight falls from ``hi`` to ``lo`` with distance over the farthest shown; all
    ``hi`` when the farthest is 0. The max is over the (n-row) nearby result."""
    mx = F.max("distance_km").over(Window.partitionBy())
    w = F.greatest(F.lit(lo), F.least(F.lit(hi), F.lit(hi) - F.col("distance_km") / mx * (hi - lo)))
    return nearby.withColumn("weight", F.when(mx > 0, w).otherwise(F.lit(hi)))


def in_bbox(df: DataFrame, bbox=C.CITY_BBOX, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows inside the bounding box (inclusive)."""
    lat_min, lat_max, lon_min, lon_max = bbox
    return df.filter(F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max))


def centroid(df: DataFrame, by: str | None = None) -> DataFrame:
    """Mean latitude/longitude (per group)."""
    aggs = [F.avg(F.col("latitude").cast("double")).alias("center_lat"),
            F.avg(F.col("longitude").cast("double")).alias("center_lon"),
            F.count("latitude").alias("n_points")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def minmax_scale(df: DataFrame, col: str, lo: float = C.MAP_RADIUS_MIN, hi: float = C.MAP_RADIUS_MAX,
                 out: str = "radius") -> DataFrame:
    """Map ``col`` linearly onto [lo, hi]; a constant column maps to the midpoint.

    min and max are a scalar subquery (partial aggregates), so no task sees all rows.
    """
    v = F.col(col).cast("double")
    bounds = df.agg(F.struct(F.min(v).alias("mn"), F.max(v).alias("mx"))).scalar()
    mn, mx = bounds["mn"], bounds["mx"]
    scaled = F.lit(lo) + (v - mn) / (mx - mn) * (hi - lo)
    return df.withColumn(out, F.when(mx > mn, scaled).otherwise(F.lit((lo + hi) / 2)))
