"""Bronze to Silver to Gold, training and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.cast import iso_date, lenient_double, lenient_id, lenient_int, release_year
from lakeloom.functions.nested import json_names, json_objects, object_names, object_names_by_role
from lakeloom.functions.score import DEFAULT_RATING, sentiment_label
from lakeloom.functions.text import clean, default_stop_words, filled, language_code, longer_than, weighted_text
from lakeloom.operators.presets import WRITER_PRODUCER_JOBS
from lakeloom.operators.quality import audit_gold, audit_layer, compression, file_inventory, inventory_size, removed_rows, union_all
from lakeloom.operators.recommend import ItemIndex
from lakeloom.operators.relational import NULL_PAIRS, keep_first, left_join
from lakeloom.operators.sentiment import SentimentModel, train_and_evaluate
from lakeloom.operators.shaping import bronze_rows
from lakeloom.plans.acquire import acquire
from lakeloom.session import materialise
from lakeloom.sources.readers import MissingInput, ORDER, optional, read_parquet, read_text_table, required
from lakeloom.sources.schemas import BRONZE
from lakeloom.sources.writers import append_batch, key_ledger, text_table_paths, write_manifest, write_parquet, write_text_copy

# Least review length, default title, Gold columns, texts to clean, weights of the soup.
REVIEW_LENGTH = 20
ORDER_TABLE = "_movie_order"
DEFAULT_TITLE = "Unknown Title"
GOLD_MOVIE_COLUMNS = ("id", "title", "original_title", "overview", "release_date", "runtime", "popularity",
                      "vote_average", "vote_count", "original_language", "poster_path", "genres_clean",
                      "production_companies_clean", "production_countries_clean")
GOLD_CREDIT_COLUMNS = ("top_cast_clean", "director_clean", "writers_producers_clean", "all_crew_clean")
GOLD_TEXT_COLUMNS = ("overview", "genres_clean", "keywords_clean", "director_clean", "top_cast_clean",
                     "writers_producers_clean")
SOUP = (("overview", 1), ("genres_clean", 2), ("keywords_clean", 2), ("director_clean", 3),
        ("top_cast_clean", 1), ("writers_producers_clean", 1))

SILVER_KEYS = {"silver_movies": ["id"], "silver_credits": ["id"], "silver_keywords": ["id"],
               "silver_reviews": ["review_id"]}


def _first_rows(bronze: DataFrame, key: str, normalise: bool, keep_order: bool = False) -> DataFrame:
    """D1 by raw key text in file order; ``normalise`` compares ids as numbers instead."""
    if ORDER not in bronze.columns:
        bronze = bronze.withColumn(ORDER, F.monotonically_increasing_id())
    if not normalise:
        first = keep_first(bronze, [key], ORDER)
    else:
        first = keep_first(bronze.withColumn("_key", lenient_id(key, "null")), ["_key"], ORDER).drop("_key")
    return first if keep_order else first.drop(ORDER)


def movie_order(bronze: DataFrame, normalise_key: bool = False) -> DataFrame:
    """(id, _order): where each movie stands in the Bronze files, which Silver and Gold columns do not say."""
    rows = _first_rows(bronze, "id", normalise_key, keep_order=True)
    return rows.select(lenient_id("id", "null").alias("id"), ORDER).groupBy("id").agg(F.max(ORDER).alias(ORDER))


def silver_movies(bronze: DataFrame, normalise_key: bool = False, on_fraction: str = "raise") -> DataFrame:
    """Deduplicated, typed movies with flattened lists."""
    rows = _first_rows(bronze, "id", normalise_key)
    return rows.withColumns({
        "id": lenient_id("id", on_fraction),
        "budget": lenient_double("budget", 0.0),
        "revenue": lenient_double("revenue", 0.0),
        "runtime": lenient_int("runtime"),
        "popularity": lenient_double("popularity", 0.0),
        "vote_average": lenient_double("vote_average", 0.0),
        "vote_count": lenient_int("vote_count"),
        "release_date": iso_date("release_date"),
        "original_language": language_code("original_language"),
        "genres_clean": json_names("genres"),
        "production_companies_clean": json_names("production_companies"),
        "production_countries_clean": json_names("production_countries"),
        "overview": filled("overview"),
        "title": filled("title", DEFAULT_TITLE),
    })


def silver_credits(bronze: DataFrame, normalise_key: bool = False, on_fraction: str = "raise") -> DataFrame:
    """Deduplicated credits with cast, director and crew names."""
    # The crew lists are most of the raw bytes, so they are parsed once for all three columns.
    parsed = _first_rows(bronze, "id", normalise_key).withColumn("_crew", json_objects("crew"))
    return parsed.withColumns({
        "id": lenient_id("id", on_fraction),
        "top_cast_clean": json_names("cast"),
        "director_clean": object_names_by_role("_crew", ["Director"]),
        "writers_producers_clean": object_names_by_role("_crew", WRITER_PRODUCER_JOBS),
        "all_crew_clean": object_names("_crew"),
    }).drop("_crew")


def silver_keywords(bronze: DataFrame, normalise_key: bool = False, on_fraction: str = "raise") -> DataFrame:
    """Deduplicated keyword lists."""
    return _first_rows(bronze, "id", normalise_key).withColumns({
        "id": lenient_id("id", on_fraction),
        "keywords_clean": json_names("keywords"),
    })


def silver_reviews(bronze: DataFrame, on_fraction: str = "raise") -> DataFrame:
    """Deduplicated, labelled reviews that are long enough."""
    rows = _first_rows(bronze, "review_id", False).withColumns({
        "movieId": lenient_id("movieId", on_fraction),
        "rating": lenient_double("rating", DEFAULT_RATING),
        "review_text": filled("review_text"),
    })
    return rows.where(longer_than("review_text", REVIEW_LENGTH)).withColumn(
        "sentiment_label", sentiment_label("rating"))


SILVER_STEPS = {
    "silver_movies": ("movies_metadata", silver_movies),
    "silver_credits": ("credits", silver_credits),
    "silver_keywords": ("keywords", silver_keywords),
    "silver_reviews": ("reviews", silver_reviews),
}


def gold_features(movies: DataFrame, credits: DataFrame, keywords: DataFrame,
                  soup: Sequence[tuple[str | Column, int]] = SOUP, null_safe: bool = True,
                  max_pairs: int | None = None, on_excess: str = "split") -> DataFrame:
    """J1 twice, cleaned text columns, release year and the weighted text.

    By default rows without a usable id match each other, every one with every
    one; ``null_safe=False`` leaves them unmatched, for input with many bad ids.
    With ``max_pairs`` such rows are counted first, and beyond it the join is
    refused or split (``on_excess``).
    """
    bounds = {"null_safe": null_safe, "max_pairs": max_pairs, "on_excess": on_excess}
    joined = left_join(movies.select(*GOLD_MOVIE_COLUMNS), credits.select("id", *GOLD_CREDIT_COLUMNS), "id", **bounds)
    joined = left_join(joined, keywords.select("id", "keywords_clean"), "id", **bounds)
    cleaned = joined.withColumns({c: clean(c) for c in GOLD_TEXT_COLUMNS})
    return cleaned.withColumns({"release_year": release_year("release_date"), "metadata_soup": weighted_text(soup)})


def land(records: DataFrame, bronze_dir: str) -> None:
    """Append detail records to the six Bronze tables.

    The records are stored once in columnar form, so that the six tables do not
    each parse the nested source again. The metadata, which decide what counts
    as known, are written last.
    """
    tables = bronze_rows(materialise(records, "records"))
    for name in sorted(tables, key=lambda n: n == "movies_metadata"):
        noted = {"key": "id", "extra": ["media_type"], "numbers": True} if name == "movies_metadata" else {}
        append_batch(tables[name], f"{bronze_dir}/{name}", **noted)


def ingest(listing: DataFrame, details: DataFrame, bronze_dir: str, target: int, **choice) -> DataFrame:
    """Choose up to ``target`` new items, land their detail records, return the choice.

    Ids already in Bronze are skipped. ``choice`` goes to ``acquire``; with
    ``by=("media_type", "id")`` a series may have the id of a movie.
    """
    ledger = key_ledger(listing.sparkSession, f"{bronze_dir}/movies_metadata", BRONZE["movies_metadata"], "id", ["media_type"], True)
    # A key noted without its kind counts as both kinds.
    kinds = F.when(F.col("media_type").isNull(), F.array(F.lit("movie"), F.lit("tv"))).otherwise(F.array("media_type"))
    existing = ledger.known(listing).select(F.col("id").try_cast("bigint").alias("id"), F.explode(kinds).alias("media_type"))
    chosen = materialise(acquire(listing, target, existing=existing, **choice), "chosen")
    # Stages before the tenth select movies, the tenth selects series.
    kind = F.when(F.col("stage") == 10, "tv").otherwise("movie")
    picked = chosen.select("id", kind.alias("media_type"))
    land(details.join(picked, ["id", "media_type"], "left_semi"), bronze_dir)
    return chosen


def read_bronze(spark: SparkSession, bronze_dir: str, na_tokens: bool = True,
                keep_order: bool = True) -> dict[str, DataFrame | None]:
    """The Bronze tables that exist, as text, in file order: ``name.csv`` files and appended batches."""
    out = {}
    for name, columns in BRONZE.items():
        paths = text_table_paths(spark, f"{bronze_dir}/{name}")
        out[name] = read_text_table(spark, paths, columns, na_tokens=na_tokens, keep_order=keep_order) if paths else None
    return out


def build_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, text_copy: bool = True) -> list[str]:
    """S10+S5+S6: rewrite the Silver tables whose Bronze table exists; returns their names."""
    bronze = read_bronze(spark, bronze_dir)
    done = []
    for name, (source, step) in SILVER_STEPS.items():
        if bronze[source] is None:
            continue
        write_parquet(step(bronze[source]), f"{silver_dir}/{name}")
        if text_copy:
            write_text_copy(read_parquet(spark, f"{silver_dir}/{name}"), f"{silver_dir}/{name}_text")
        if name == "silver_movies":
            write_parquet(movie_order(bronze[source]), f"{silver_dir}/{ORDER_TABLE}")
        done.append(name)
    return done


def build_gold(spark: SparkSession, silver_dir: str, gold_dir: str, text_copy: bool = True,
               null_safe: bool = True) -> DataFrame:
    """S10+S5+S6: rewrite the Gold feature table from the three required Silver tables."""
    tables = [required(read_parquet, spark, f"{silver_dir}/{t}")
              for t in ("silver_movies", "silver_credits", "silver_keywords")]
    path = f"{gold_dir}/gold_movies_features"
    write_parquet(gold_features(*tables, null_safe=null_safe, max_pairs=NULL_PAIRS), path)
    gold = read_parquet(spark, path)
    if text_copy:
        write_text_copy(gold, f"{path}_text")
    order = optional(read_parquet, spark, f"{silver_dir}/{ORDER_TABLE}")
    if order is not None:
        write_parquet(order, f"{gold_dir}/{ORDER_TABLE}")
    return gold


def train_recommender(spark: SparkSession, gold_dir: str, models_dir: str,
                      stop_words: Sequence[str] | None = None) -> ItemIndex:
    """H1, H2, H6 over the Gold table, in the order of the Bronze files: of equal titles the last one answers."""
    gold = required(read_parquet, spark, f"{gold_dir}/gold_movies_features")
    order = optional(read_parquet, spark, f"{gold_dir}/{ORDER_TABLE}")
    if order is not None:
        gold = gold.join(order, "id", "left")
    words = default_stop_words() if stop_words is None else stop_words
    return ItemIndex.build(gold, stop_words=words, path=f"{models_dir}/recommender",
                           order=None if order is None else ORDER)


def train_sentiment(spark: SparkSession, silver_dir: str, models_dir: str,
                    stop_words: Sequence[str] | None = None) -> tuple[SentimentModel, DataFrame]:
    """H7-H12 over the Silver reviews; stores the model and its report."""
    reviews = required(read_parquet, spark, f"{silver_dir}/silver_reviews")
    words = default_stop_words() if stop_words is None else stop_words
    labelled = reviews.withColumn("label", F.when(F.col("sentiment_label") == "positive", 1).otherwise(0))
    model, report = train_and_evaluate(labelled, key="review_id", text="review_text", label="label",
                                       stop_words=words, path=f"{models_dir}/sentiment")
    write_manifest(report, f"{models_dir}/sentiment_metrics")
    return model, spark.read.schema(report.schema).json(f"{models_dir}/sentiment_metrics")


def audit(spark: SparkSession, bronze_dir: str, silver_dir: str, gold_dir: str,
          recommender: ItemIndex | None = None, classifier: SentimentModel | None = None,
          metrics: DataFrame | None = None) -> dict[str, DataFrame]:
    """Write and return the manifest of every layer."""
    bronze = read_bronze(spark, bronze_dir, keep_order=False)
    silver = {n: optional(read_parquet, spark, f"{silver_dir}/{n}") for n in SILVER_STEPS}
    gold = required(read_parquet, spark, f"{gold_dir}/gold_movies_features")
    raw = {n: text_table_paths(spark, f"{bronze_dir}/{n}") for n in BRONZE}
    manifests = {
        "bronze": (audit_layer(bronze, "Bronze", "bronze_ingestion", paths=raw), bronze_dir),
        "silver": (audit_layer(silver, "Silver", "silver_transformation", SILVER_KEYS,
                               {n: [f"{silver_dir}/{n}"] for n in SILVER_STEPS}), silver_dir),
        "gold": (audit_gold(gold, recommender, classifier, metrics), gold_dir),
    }
    for name, (manifest, folder) in manifests.items():
        write_manifest(manifest, f"{folder}/{name}_manifest")
    return {n: m for n, (m, _) in manifests.items()}


def removed_report(spark: SparkSession, bronze_dir: str, silver_dir: str) -> DataFrame:
    """A4: rows before, after and removed per Silver step."""
    bronze = read_bronze(spark, bronze_dir, keep_order=False)
    return union_all([removed_rows(bronze[source], read_parquet(spark, f"{silver_dir}/{name}"), name)
                      for name, (source, _) in SILVER_STEPS.items() if bronze[source] is not None])


def compression_report(spark: SparkSession, bronze_dir: str, silver_dir: str) -> DataFrame:
    """Q4: size of each raw text table against the Silver table made of it."""
    bronze = read_bronze(spark, bronze_dir, keep_order=False)
    present = [(name, source) for name, (source, _) in SILVER_STEPS.items() if bronze[source] is not None]
    size = lambda paths, name: inventory_size(file_inventory(spark, paths), name)
    return compression(union_all([size(text_table_paths(spark, f"{bronze_dir}/{source}"), name) for name, source in present]),
                       union_all([size(f"{silver_dir}/{name}", name) for name, _ in present]))


def run_all(spark: SparkSession, bronze_dir: str, silver_dir: str, gold_dir: str, models_dir: str,
            stop_words: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The whole flow over landed Bronze tables; returns the manifests."""
    if not build_silver(spark, bronze_dir, silver_dir):
        raise MissingInput(f"no Bronze table under {bronze_dir}")
    build_gold(spark, silver_dir, gold_dir)
    recommender = train_recommender(spark, gold_dir, models_dir, stop_words)
    classifier, metrics = train_sentiment(spark, silver_dir, models_dir, stop_words)
    return audit(spark, bronze_dir, silver_dir, gold_dir, recommender, classifier, metrics)
