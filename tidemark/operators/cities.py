"""Cities against a gazetteer: known names, and the most similar place of a state and ZIP."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaro_bound, jaro_similarity, letter_counts
from ..functions.text import normalise_address
from ..sources.tables import staged


def matched_cities(rows: DataFrame, city: Column, state: Column, zip_: Column, gazetteer: DataFrame, threshold: float) -> DataFrame:
    """(city, state, zip, is_city, place, distance), written, for each combination of rows that differs.

    is_city: the gazetteer (city, state_id, zip) has the name, anywhere. place is the gazetteer's city of that state and ZIP
    of the least Jaro distance below the threshold, to nine digits, ties to the least name; place and distance are null if
    there is none. Names are compared as normalised addresses; pairs are bounded by lengths and letters before the distance
    is computed. Each combination is compared once, however many rows have it, with the places of its ZIP alone.
    """
    asked = rows.select(city.alias("city"), state.alias("state"), zip_.alias("zip")).distinct()
    known = gazetteer.select(F.col("city").alias("name")).filter("name is not null").distinct().withColumn("is_city", F.lit(True))
    asked = asked.join(known, F.col("city") == F.col("name"), "left").select("city", "state", "zip", F.coalesce("is_city", F.lit(False)).alias("is_city"))
    asked = staged(asked.withColumn("v", normalise_address(F.col("city"))).withColumn("letters", letter_counts(F.col("v"))), "cities")
    places = gazetteer.select(F.col("city").alias("place"), F.col("state_id").alias("of_state"), F.col("zip").alias("of_zip"), normalise_address(F.col("city")).alias("w")).filter("place is not null").distinct()
    places = places.withColumn("letters_w", letter_counts(F.col("w")))
    short, long = F.least(F.length("v"), F.length("w")), F.greatest(F.length("v"), F.length("w"))
    pairs = asked.join(places, (F.col("state") == F.col("of_state")) & (F.col("zip") == F.col("of_zip")) & (2 * long + short >= long * (3 - 3 * threshold - 1e-9)))
    pairs = pairs.filter(jaro_bound(F.col("v"), F.col("w"), F.col("letters"), F.col("letters_w")) > 1 - threshold - 1e-9)
    pairs = pairs.withColumn("distance", F.round(1 - jaro_similarity("v", "w"), 9)).filter(F.col("distance") < threshold)
    best = pairs.groupBy("city", "state", "zip").agg(F.min(F.struct("distance", "place")).alias("best"))
    best = best.select(F.col("city").alias("c"), F.col("state").alias("s"), F.col("zip").alias("z"), "best")
    out = asked.join(best, (F.col("city") == F.col("c")) & (F.col("state") == F.col("s")) & (F.col("zip") == F.col("z")), "left")
    return staged(out.select("city", "state", "zip", "is_city", "best.place", "best.distance"), "places")
