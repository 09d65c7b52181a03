"""Text columns: title normalisation, truncation, tokens and WordPiece ids."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators.joins import BROADCAST_BYTES, join_counted
from vecframe.session import shared_dir, spread

# Character classes spelled out, since the engines' shorthands differ in scope.
SPACES = r"[\s\x1C-\x1F\x85\p{Z}]+"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s\x1C-\x1F\x85\p{Z}]"
ASCII_PUNCTUATION = r"!-/:-@\[-`{-~"
DROPPED = r"[\p{Mn}\uFFFD[\p{C}&&[^\t\n\r]]]"
TOKEN = rf"[{ASCII_PUNCTUATION}\p{{P}}]|[^ \t\n\r\p{{Zs}}{ASCII_PUNCTUATION}\p{{P}}]+"

# Limits and special tokens of the text encoder, and of the stored plots.
MAX_TOKENS = 256
MAX_WORD = 100
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]
MAX_TEXT = 800
LOOK_BACK = 100


def normalize_title(title: Column) -> Column:
    """Lower case, without punctuation, single spaces; null becomes the empty string."""
    bare = F.regexp_replace(F.lower(title), NOT_WORD_OR_SPACE, "")
    return F.coalesce(F.trim(F.regexp_replace(bare, SPACES, " ")), F.lit(""))


def truncate_text(text: Column, limit: int = MAX_TEXT, look_back: int = LOOK_BACK) -> Column:
    """At most ``limit`` characters, cut back to the last space within ``look_back``, and an ellipsis."""
    cut = F.substring(text, 1, limit)
    from_end = F.instr(F.reverse(cut), " ")
    last_space = F.lit(limit) - from_end
    whole_words = (from_end > 0) & (last_space > limit - look_back)
    shortened = F.when(whole_words, F.substring(cut, F.lit(1), last_space)).otherwise(cut)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(shortened, F.lit(" …")))


def strip_text(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, f"^{SPACES}|{SPACES}$", "")


@F.arrow_udf(T.StringType())
def _decompose(texts: pa.Array) -> pa.Array:
    """Lower case in NFD, which Spark has no function for."""
    parts = (text if text is None else unicodedata.normalize("NFD", text.lower()) for text in texts.to_pylist())
    return pa.array(parts, type=pa.string())


# The marks for a token that cannot be split, and for the begin and end of a text.
MARKS = ("[UNK]", "[CLS]", "[SEP]")


def fold_text(text: Column) -> Column:
    """Lower case without accents and control characters.

    Only texts with a non-ASCII character leave the JVM, to be decomposed.
    """
    parts = F.coalesce(_decompose(F.when(F.regexp_like(text, F.lit(r"[^\x00-\x7F]")), text)), F.lower(text))
    return F.regexp_replace(parts, DROPPED, "")


def basic_tokens(text: Column) -> Column:
    """Words and single punctuation marks of the folded text."""
    return F.regexp_extract_all(fold_text(text), F.lit(TOKEN), F.lit(0))


def count_tokens(df: DataFrame, text: str) -> DataFrame:
    """How often each token occurs: ``token, n``, counted in part before the shuffle.

    The outer explode keeps Spark from adding a filter on the token array, which would tokenise twice.
    """
    tokens = spread(df.select(text)).select(F.explode_outer(basic_tokens(F.col(text))).alias("token"))
    return tokens.where(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("n"))


def wordpiece_join(
    texts: DataFrame, vocabulary: DataFrame, *, key: str, text: str, broadcast_limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows (key, ids) as ``wordpiece_ids`` makes them, under a vocabulary of any size: a stored table (piece, id) with unique pieces.

    Each distinct token is split once: all its substrings that could be pieces are joined with the vocabulary, and the longest at each start are
    chained. Ids go back to the texts by a join on the token, in which very frequent tokens travel. Only the first 256 tokens of a
    text are looked at, since each has a piece at least and no more are returned. Nothing but the ids of the three marks reaches the driver.
    """
    spark = texts.sparkSession
    marks = {r.piece: r.id for r in vocabulary.where(F.col("piece").isin(*MARKS)).collect()}
    if missing := [t for t in MARKS if t not in marks]:
        raise ValueError(f"the vocabulary lacks {missing}")
    unknown, first, last = (F.array(F.lit(marks[t]).cast("int")) for t in MARKS)
    tokens = F.slice(basic_tokens(F.coalesce(F.col(text), F.lit(""))), 1, MAX_TOKENS)
    rows = _stored(spread(texts.select(key, text)).select(F.col(key).alias("_key"), tokens.alias("_tokens"), F.monotonically_increasing_id().alias("_row")), "tokens")
    placed = rows.select("_row", F.posexplode("_tokens").alias("place", "token"))
    counted = _stored(placed.groupBy("token").agg(F.count("*").alias("copies")), "distinct-tokens")

    longest = vocabulary.agg(F.max(F.length("piece"))).first()[0]
    short = counted.where(F.length("token") <= MAX_WORD).select("token", F.length("token").alias("length"))
    starts = short.select("token", "length", F.explode(F.sequence(F.lit(1), F.col("length"))).alias("start"))
    sizes = F.sequence(F.lit(1), F.least(F.col("length") - F.col("start") + 1, F.lit(longest)))
    spans = starts.select("token", "start", F.explode(sizes).alias("size"))
    lead = F.when(F.col("start") > 1, "##").otherwise("")
    pieces = spans.withColumn("piece", F.concat(lead, F.substring("token", F.col("start"), F.col("size"))))
    known = vocabulary.select("piece", "id")
    few = known.agg(F.sum(F.length("piece") + 32)).first()[0] <= broadcast_limit
    matched = pieces.join(F.broadcast(known) if few else known, "piece")
    best = matched.groupBy("token", "start").agg(F.max(F.struct("size", "id")).alias("best"))
    found = best.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("start", "best"))).alias("found"))  # at most 100 a token
    begin = F.struct(F.lit(1).alias("next"), F.expr("cast(array() as array<int>)").alias("ids"))
    step = lambda at, x: F.when(
        x["start"] == at["next"], F.struct((at["next"] + x["best"]["size"]).alias("next"), F.concat(at["ids"], F.array(x["best"]["id"].cast("int"))).alias("ids"))
    ).otherwise(at)
    walked = found.withColumn("walk", F.aggregate("found", begin, step))
    whole = walked.where(F.col("walk")["next"] == F.length("token") + 1).select("token", F.col("walk")["ids"].alias("ids"))
    split = _stored(counted.join(whole, "token", "left").select("token", "copies", F.coalesce("ids", unknown).alias("ids")), "split-tokens")

    coded = join_counted(placed, split, ["token"], row_bytes=120, limit=broadcast_limit).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("place", "ids"))).alias("coded"))
    ids = F.concat(first, F.coalesce(F.flatten(F.col("coded.ids")), F.expr("cast(array() as array<int>)")), last)
    return rows.join(coded, "_row", "left").select(F.col("_key").alias(key), F.slice(ids, 1, MAX_TOKENS).alias("ids"))


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wordpiece_ids(text: Column, vocabulary: list[str]) -> Column:
    """Ids of the longest pieces, between [CLS] and [SEP], cut to 256 after adding both.

    The vocabulary goes to every task, so a task must be able to hold it.
    """
    ids = {piece: i for i, piece in enumerate(vocabulary)}
    missing = [t for t in MARKS if t not in ids]
    if missing:
        raise ValueError(f"the vocabulary lacks {missing}")
    first, last, unknown = ids["[CLS]"], ids["[SEP]"], ids["[UNK]"]

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def pieces(words: pa.Array) -> pa.Array:
        coded = words.flatten().dictionary_encode()
        parts = [_split_word(word, ids, unknown) for word in coded.dictionary.to_pylist()]
        sizes = np.array([len(part) for part in parts], dtype=np.int64)
        at = coded.indices.to_numpy(zero_copy_only=False)
        flat = pa.array(parts, type=pa.list_(pa.int32())).take(coded.indices).flatten().to_numpy(zero_copy_only=False)
        # Where each text starts: in words, then in pieces.
        starts = words.offsets.to_numpy() - words.offsets[0].as_py()
        starts = np.concatenate([[0], np.cumsum(sizes[at])])[starts]
        # The closing mark is cut off too where the pieces leave no room for it.
        found = np.diff(starts)
        kept, closed = np.minimum(found, MAX_TOKENS - 1), found < MAX_TOKENS - 1
        ends = np.cumsum(kept + 1 + closed)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        out = np.full(int(ends[-1]) if len(ends) else 0, last, dtype=np.int32)
        out[begins] = first
        within = np.arange(kept.sum()) - np.repeat(np.cumsum(kept) - kept, kept)
        out[np.repeat(begins + 1, kept) + within] = flat[np.repeat(starts[:-1], kept) + within]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(out))

    return pieces(basic_tokens(F.coalesce(text, F.lit(""))))


def _split_word(word: str, ids: dict[str, int], unknown: int) -> list[int]:
    if len(word) > MAX_WORD:
        return [unknown]
    found, rest, lead = [], word, ""
    while rest:
        size = next((n for n in range(len(rest), 0, -1) if lead + rest[:n] in ids), None)
        if size is None:
            return [unknown]
        found.append(ids[lead + rest[:size]])
        rest, lead = rest[size:], "##"
    return found
