"""Places that lie near each other, and what their neighbours count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.operators.features import REGION, add_case_lags

EARTH_KM = 6371.0
# What a region's neighbours add to the model's inputs.
NEIGHBOUR_FEATURES = ["neighbour_cases", "neighbours"]


def _on_sphere(latitude: Column, longitude: Column) -> list[Column]:
    """A place as a point in space, in km from the centre of the earth."""
    lat, lon = F.radians(latitude.cast("double")), F.radians(longitude.cast("double"))
    return [F.lit(EARTH_KM) * c for c in (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))]


def distance_km(latitude: Column, longitude: Column, other_latitude: Column, other_longitude: Column) -> Column:
    """Great-circle distance (haversine)."""
    lat, lon, lat2, lon2 = (F.radians(c.cast("double")) for c in (latitude, longitude, other_latitude, other_longitude))
    a = (F.pow(F.sin((lat2 - lat) / 2), 2) + F.cos(lat) * F.cos(lat2) * F.pow(F.sin((lon2 - lon) / 2), 2))
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def station_places(obs: DataFrame, station_regions: DataFrame) -> DataFrame:
    """(city, latitude, longitude): the mean position of a region's stations.

    Each station's readings of its own position shrink to one row before the join.
    """
    at = obs.groupBy("STATION").agg(F.avg("LATITUDE").alias("latitude"), F.avg("LONGITUDE").alias("longitude"))
    return (at.join(station_regions.select("STATION", REGION), "STATION").groupBy(REGION)
            .agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")))


def near_places(places: DataFrame, radius_km: float, key: str = REGION) -> DataFrame:
    """Pairs of different places at most ``radius_km`` apart, both ways: (key, neighbour, km).

    Places (key, latitude, longitude) are points in space in a grid of cubes as wide as the radius
    (a straight line is no longer than the arc), so near ones lie in the same or in touching cubes.
    One side goes to its cube and the 26 around it and meets the other by equality of the cube; the
    exact distance decides. Nothing changes at the poles or where the longitude jumps. Work
    follows the number of pairs in touching cubes, not that of all pairs. Places without a position
    have no neighbours.
    """
    if radius_km <= 0:
        raise ValueError("the radius must be positive")
    cell = [F.floor(c / F.lit(float(radius_km))).cast("int") for c in _on_sphere(F.col("latitude"), F.col("longitude"))]
    located = (places.select(F.col(key).alias("place"), "latitude", "longitude").dropna()
               .select("*", *[c.alias(n) for c, n in zip(cell, "xyz")]))
    around = located.toDF("near", "near_latitude", "near_longitude", "x", "y", "z")
    for axis in "xyz":
        around = around.withColumn(axis, F.explode(F.array(*[F.col(axis) + d for d in (-1, 0, 1)])))
    pairs = located.join(around, ["x", "y", "z"]).filter(F.col("place") != F.col("near"))
    km = distance_km(F.col("latitude"), F.col("longitude"), F.col("near_latitude"), F.col("near_longitude"))
    return (pairs.select(F.col("place").alias(key), F.col("near").alias("neighbour"), km.alias("km"))
            .filter(F.col("km") <= radius_km))


def neighbour_lags(weeks: DataFrame, cases: DataFrame, near: DataFrame) -> DataFrame:
    """(city, year, weekofyear, neighbour_cases, neighbours): for the weeks of each region, the mean
    of its neighbours' last counts before that week, and how many neighbours had one.

    A neighbour's last count is that of the row before the week in its own history, as in
    ``add_case_lags``, for weeks that it counted; weeks without a counting neighbour are left out.
    """
    lagged = add_case_lags(cases, steps=1).select(F.col(REGION).alias("neighbour"), "year", "weekofyear", "lag_cases")
    key = [REGION, "year", "weekofyear"]
    wanted = weeks.select(REGION, *[F.col(c).cast("int").alias(c) for c in key[1:]])
    met = (wanted.join(near.select(REGION, "neighbour"), REGION)
           .join(lagged.withColumns({c: F.col(c).cast("int") for c in key[1:]}), ["neighbour", "year", "weekofyear"])
           .filter(F.col("lag_cases").isNotNull()))
    return met.groupBy(*key).agg(F.avg("lag_cases").alias("neighbour_cases"), F.count("*").cast("double").alias("neighbours"))


def add_neighbour_lags(rows: DataFrame, cases: DataFrame, near: DataFrame) -> DataFrame:
    """Feature rows with ``NEIGHBOUR_FEATURES``; 0 where no neighbour counted."""
    found = neighbour_lags(rows, cases, near)
    types = dict(rows.dtypes)
    found = found.withColumns({c: F.col(c).cast(types[c]) for c in ("year", "weekofyear")})
    return rows.join(found, [REGION, "year", "weekofyear"], "left").fillna(0.0, NEIGHBOUR_FEATURES)
