"""Building a searchable corpus: filter, join with a popularity list, rank, number, embed, store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecframe.functions.encoders import Encoder
from vecframe.functions.text import normalize_title, strip_text, truncate_text
from vecframe.operators.knn import knn_join
from vecframe.session import shared_dir, spread

# Shape of the sample corpus.
TOP_N = 5000
MIN_TEXT = 200
ID_FORMAT = "film-%05d"
# Winners up to this many, about 100 bytes each, travel to the texts; more are joined by shuffle.
BROADCAST_SELECTED = 500_000
COLUMNS = ["id", "title", "year", "genre", "plot", "vector"]


def corpus_filter(
    texts: DataFrame, *, title: str, year: str, text: str, group: str, groups: list[str], min_length: int = MIN_TEXT
) -> DataFrame:
    """Rows with title, year and text, of a wanted group, and long enough."""
    whole = texts.dropna(subset=[title, year, text])
    return whole.where(F.col(group).isin(groups) & (F.length(text) >= min_length))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in an explicit order.

    Spark keeps one row per key and task before the shuffle, so many copies of one key cost little.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def row_ids(df: DataFrame, order: list[Column], *, name: str = "id", id_format: str = ID_FORMAT) -> DataFrame:
    """Dense ids in order. Rows are ranged over tasks, which number their own after the counts of those before."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    path = shared_dir(df.sparkSession, "numbered")
    placed.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)}).write.parquet(path)
    placed = df.sparkSession.read.parquet(path)
    # One row per task that has rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn(name, F.format_string(id_format, F.col("_start") + F.col("_at"))).drop("_part", "_start", "_at")


def match_popularity(texts: DataFrame, popularity: DataFrame, *, position: str = "position") -> DataFrame:
    """First text and most popular entry per (normalised title, year), as keys, position and popularity.

    ``texts`` has ``title, year`` and a ``position`` that names and orders its rows; ``popularity`` has
    ``title, year, popularity`` and its own ``position`` for ties. Texts are thinned before the join:
    the join keeps or drops all rows of a key alike, so the first row is the same, and copies never
    meet the join. Both sides are then partitioned by the join keys already.
    """
    keys = ["title_norm", "year"]
    title = normalize_title(F.col("title")).alias("title_norm")
    ranked = popularity.select(title, "year", "popularity", position)
    ranked = keep_first(ranked, keys, [F.desc("popularity"), F.asc(position)]).drop(position)
    first = keep_first(spread(texts.select("title", "year", position)).select(title, "year", position), keys, [F.asc(position)])
    return first.join(ranked, keys, "inner")


def build_corpus(
    texts: DataFrame,
    popularity: DataFrame,
    encoder: Encoder,
    *,
    groups: list[str],
    group: str = "origin",
    position: str = "position",
    n: int = TOP_N,
) -> DataFrame:
    """``id, title, year, genre, plot, vector`` of the n most popular texts.

    ``texts`` has ``title, year, genre, plot``, the ``group`` column and a unique ``position``. Matching
    and ranking move titles and positions only; the texts are read again for the n winners.
    """
    wanted = corpus_filter(texts, title="title", year="year", text="plot", group=group, groups=groups)
    wanted = wanted.withColumn("year", F.col("year").cast("int"))
    order = [F.desc("popularity"), F.asc(position)]
    best = row_ids(top_n(match_popularity(wanted, popularity, position=position), n, order), order)
    chosen = best.select("id", position)
    final = texts.join(F.broadcast(chosen) if n <= BROADCAST_SELECTED else chosen, position).select(
        "id", strip_text(F.col("title")).alias("title"), F.col("year").cast("int").alias("year"),
        F.col("genre").cast("string").alias("genre"), truncate_text(F.col("plot")).alias("plot"),
    )
    return final.withColumn("vector", encoder.column(F.col("plot")))


def write_corpus(corpus: DataFrame, path: str) -> None:
    corpus.write.mode("overwrite").option("compression", "zstd").parquet(path)


def selected_range(df: DataFrame, column: str = "popularity") -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"))


def validate_corpus(
    corpus: DataFrame,
    *,
    dimension: int,
    rows: tuple[int, int] = (4000, 6000),
    lengths: tuple[int, int] = (100, 1000),
    years: tuple[int, int] = (1950, 2010),
) -> DataFrame:
    """One row of violation counts; all zero means the corpus is as described.

    ``years`` asks for a text before the first year and one from the second or later.
    """
    missing = sorted(set(COLUMNS) ^ set(corpus.columns))
    count = F.count("*")
    length = F.length("plot")
    outside = F.when(count.between(*rows), 0).otherwise(1)
    return corpus.agg(
        F.lit(len(missing)).cast("long").alias("wrong_columns"),
        outside.cast("long").alias("row_count_outside"),
        F.count_if(F.col("vector").isNull() | (F.size("vector") != dimension)).alias("wrong_dimension"),
        F.count_if(length < lengths[0]).alias("too_short"),
        F.count_if(length > lengths[1]).alias("too_long"),
        F.when(F.min("year") < years[0], 0).otherwise(1).cast("long").alias("no_early_year"),
        F.when(F.max("year") >= years[1], 0).otherwise(1).cast("long").alias("no_late_year"),
    )


def semantic_search(corpus: DataFrame, texts: DataFrame, encoder: Encoder, *, text: str, query_id: str, **options) -> DataFrame:
    """Search an embedded corpus by text, with the encoder that built it."""
    asked = texts.withColumn("_query", encoder.column(F.col(text)))
    return knn_join(corpus, asked, query_id=query_id, query_vector="_query", **options)
