"""Landed feed entries and GDELT records, normalised to raw articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newslens.functions import scores, text

# Fixed values.
ENTRIES_PER_FEED = 20
FEED_COLUMNS = ("name", "url", "lang", "category")
RELIABLE_FEEDS = (
    ("AFP", "https://www.afp.com/fr/actualites/feeds/feed-afp-com.xml", "fr", "reliable"),
    ("Reuters", "https://feeds.reuters.com/reuters/topNews", "en", "reliable"),
    ("BBC News", "https://feeds.bbci.co.uk/news/world/rss.xml", "en", "reliable"),
    ("Al Jazeera", "https://www.aljazeera.com/xml/rss/all.xml", "en", "reliable"),
    ("Le Monde", "https://www.lemonde.fr/rss/une.xml", "fr", "reliable"),
    ("RFI", "https://www.rfi.fr/fr/rss", "fr", "reliable"),
    ("AP News", "https://rsshub.app/apnews/topics/apf-topnews", "en", "reliable"),
    ("Deutsche Welle", "https://rss.dw.com/xml/rss-en-world", "en", "reliable"),
    ("France24", "https://www.france24.com/fr/rss", "fr", "reliable"),
    ("VOA News", "https://www.voanews.com/rss/", "en", "reliable"),
    ("Jeune Afrique", "https://www.jeuneafrique.com/feed/", "fr", "reliable"),
    ("Africa News", "https://www.africanews.com/feed/rss", "en", "reliable"),
)
SUSPICIOUS_FEEDS: tuple[tuple[str, str, str, str], ...] = ()


def feed_registry(spark: SparkSession, extra: tuple = ()) -> DataFrame:
    """All feeds that are scraped; ``extra`` rows extend the list of suspicious ones."""
    rows = [*RELIABLE_FEEDS, *SUSPICIOUS_FEEDS, *extra]
    return spark.createDataFrame(rows, "name string, url string, lang string, category string")


def first_entries(entries: DataFrame, order: Sequence[str], scrape: Sequence[str] = ("feed", "scrape"), n: int = ENTRIES_PER_FEED) -> DataFrame:
    """The first ``n`` entries of every scrape of a feed in ``order``. No task sends more than
    ``n`` rows of a scrape into the shuffle."""
    place = Window.partitionBy(*scrape).orderBy(*order)
    return entries.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= n).drop("_place")


def normalise_feed(entries: DataFrame, registry: DataFrame, scraped_at: Column, order: Sequence[str] = ()) -> DataFrame:
    """Feed entries (feed, title, summary, link) to articles, the first 20 of each scrape.

    Give ``order`` for entries with a column ``scrape``: they are counted here. Entries that carry
    their 1-based ``position`` in the scrape need none, and the filter reaches the scan. The
    registry is the fixed feed list above.
    """
    entries = first_entries(entries, order) if order else entries.filter(F.col("position") <= ENTRIES_PER_FEED)
    feeds = F.broadcast(registry.select(F.col("name").alias("feed"), "lang", "category"))
    return (
        entries.join(feeds, "feed", "left")
        .select(
            text.content_id(F.col("link"), F.col("title")).alias("id"),
            text.or_empty(F.col("title")).alias("title"),
            F.substring(text.or_empty(F.col("summary")), 1, text.FEED_BODY_CHARS).alias("body"),
            text.or_empty(F.col("link")).alias("url"),
            F.col("feed").alias("source"),
            F.coalesce("category", F.lit("reliable")).alias("source_category"),
            F.coalesce("lang", F.lit("en")).alias("language"),
            scraped_at.alias("timestamp"),
            F.lit(0.0).alias("gdelt_tone"),
        )
    )


def normalise_gdelt(records: DataFrame, fetched_at: Column) -> DataFrame:
    """GDELT records (url, title, seendate, domain, language, tone) to articles.

    The language is the first two letters of its English name.
    """
    return records.select(
        text.content_id(F.col("url"), F.col("title")).alias("id"),
        text.or_empty(F.col("title")).alias("title"),
        text.or_empty(F.col("seendate")).alias("body"),
        text.or_empty(F.col("url")).alias("url"),
        F.coalesce("domain", F.lit("gdelt")).alias("source"),
        F.lit("gdelt").alias("source_category"),
        F.substring(F.lower(F.coalesce("language", F.lit("English"))), 1, 2).alias("language"),
        fetched_at.alias("timestamp"),
        scores.safe_tone(F.col("tone")).alias("gdelt_tone"),
    )
