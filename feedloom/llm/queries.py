"""Queries of the text problems (p2, p7 to p10) over their whole tables, and the SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import leakage, moderation, names, places, tokenize


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = table(spark, sf_dir, "schedule_feeds")
    return places.match_places(feeds, "feed_row_id", "location.country_code", "location.subdivision_name", "location.municipality", table(spark, sf_dir, "places"))


def p2_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries within the distance of each row's typed values."""
    feeds = table(spark, sf_dir, "schedule_feeds")
    return places.candidates(feeds, "feed_row_id", "location.country_code", "location.subdivision_name", "location.municipality", table(spark, sf_dir, "places"))


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed values without an entry, and how many rows have them."""
    feeds = table(spark, sf_dir, "schedule_feeds").select("feed_row_id", "location.country_code", "location.subdivision_name", "location.municipality")
    none = p2_found(spark, sf_dir).filter("place_id = 0").select(F.col("feed_row_id").alias("row"))
    return feeds.join(none, feeds["feed_row_id"] == none["row"], "left_semi").groupBy("country_code", "subdivision_name", "municipality").agg(F.count(F.lit(1)).alias("n_rows"))


def _organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.same_organisation(table(spark, sf_dir, "schedule_feeds"), "feed_row_id", "provider", "name")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.variant_pairs(_organisations(spark, sf_dir)).select(F.col("a").alias("feed_row_a"), F.col("b").alias("feed_row_b"))


def p7_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's organisation."""
    return _organisations(spark, sf_dir).select(F.col("row").alias("feed_row_id"), "entity")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p9_reparameterised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.reparameterised(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def _moderated(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    countries = table(spark, sf_dir, "places").select("country_name")
    return moderation.moderate(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "moderation_examples"), countries, keep)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation.present(_moderated(spark, sf_dir), "doc_id")


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moderated(spark, sf_dir)


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation.rates(_moderated(spark, sf_dir, ("source",)), "source")


def queries() -> dict:
    found = (p2_found, p2_candidates, p2_unmatched, p7_found, p7_entities, p8_ids, p9_found, p9_reparameterised, p10_found, p10_scores, p10_rates)
    return {f.__name__: f for f in found}


_P9 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
dw AS (SELECT doc_id, array_to_string(w[n:n + 11], ' ') AS passage FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS n FROM d WHERE len(w) >= 12)),
iw AS (SELECT item_id, array_to_string(w[n:n + 11], ' ') AS passage FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS n FROM i WHERE len(w) >= 12))
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (passage)
"""


def oracle_sql() -> dict[str, str]:
    return {"p9_found": _P9}
