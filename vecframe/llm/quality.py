"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import batch_of, modest_batches, small_side, stored, text_chunks
from vecframe.llm.shingles import mix, span_hashes, word_spans

ORDER = 5
#: A character is its code point plus 1; 0 stands before the text. A gram is two longs: ``lo`` has its last two characters, ``hi`` those before.
BITS = 21
LAST = (1 << BITS) - 1
#: A character that the model does not know at all has the probability 1 / CLASSES.
CLASSES = 4096
#: A document is kept up to MARGIN times the perplexity that a share QUANTILE of trusted texts of its language stay below.
QUANTILE = 0.99
MARGIN = 1.5
#: Rows of the model in one shard. A shard is sent to every task; each shard is one more function over the documents.
SHARD_ROWS = 4_000_000
GRAMS_HELD = 2_000_000
LEAST_DISCOUNT = 0.1
#: Characters at the language's own rate that every text is taken to have besides its own, so that few characters do not condemn a text.
PRIOR_CHARS = 100


def ending(hi, lo, length: int):
    """The last ``length`` characters of grams, in columns or arrays."""
    masks = (1 << (BITS * max(length - 2, 0))) - 1, (1 << (BITS * min(length, 2))) - 1
    return (hi.bitwiseAND(masks[0]), lo.bitwiseAND(masks[1])) if isinstance(hi, Column) else (hi & masks[0], lo & masks[1])


def before_last(hi, lo):
    """Grams without their last character, in columns or arrays."""
    if isinstance(hi, Column):
        return F.shiftright(hi, BITS), F.shiftright(lo, BITS).bitwiseOR(F.shiftleft(hi.bitwiseAND(LAST), BITS))
    return hi >> BITS, lo >> BITS | (hi & LAST) << BITS


def keys_of(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """64 bits of hash of grams of one length."""
    return mix(mix(hi.astype(np.uint64)) ^ lo.astype(np.uint64))


def characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, as ``hi`` and ``lo``, and each text's number of them.

    White space between words is one space; a word that repeats the one before it is one character.
    """
    texts = len(bounds) - 1
    starts, ends, text = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    firsts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    begin, end, limit = firsts[starts], firsts[ends], firsts[bounds]
    steps = np.zeros(len(codes) + 1, np.int8)
    steps[begin[~again]] += 1
    steps[end[~again]] -= 1
    keep = np.cumsum(steps[:-1], dtype=np.int8).astype(bool)
    keep[begin[again]] = True
    codes[begin[again]] = 0
    gaps = end[end < limit[text + 1]]
    keep[gaps] = True
    codes[gaps] = 0x20
    owner = np.repeat(np.arange(texts), np.diff(limit))[keep]
    at = np.arange(len(owner)) + (ORDER - 1) * (owner + 1)
    line = np.zeros(len(owner) + (ORDER - 1) * texts, np.int64)
    line[at] = codes[keep].astype(np.int64) + 1
    lo = line[at] | line[at - 1] << BITS
    hi = line[at - 2]
    for k in range(3, ORDER):
        hi |= line[at - k] << (BITS * (k - 2))
    return hi, lo, np.bincount(owner, minlength=texts)


def _counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hi, lo = (np.concatenate(part) for part in zip(*held, strict=True))
    order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    first = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
    return hi[first], lo[first], np.diff(np.append(first, len(hi)))


def count_grams(texts: DataFrame) -> DataFrame:
    """Rows (hi, lo, n) of the n-grams of highest order in the column ``text``; tasks count before the shuffle."""
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, data, bounds in text_chunks(batch.column("text")):
                held.append(characters(data, bounds)[:2])
                size += len(held[-1][0])
                if size > GRAMS_HELD:
                    yield batch_of(schema, *_counted(held))
                    held, size = [], 0
        if size:
            yield batch_of(schema, *_counted(held))

    return texts.select("text").mapInArrow(count, "hi long, lo long, n long").groupBy("hi", "lo").agg(F.sum("n").alias("n"))


def discounts(grams: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney from the counts of counts, between LEAST_DISCOUNT and the count they lower.

    Where there is no such count, LEAST_DISCOUNT: something must be left for shorter contexts.
    """
    n = [0, 0, 0, 0]
    for row in grams.where("n <= 4").groupBy("n").count().collect():
        n[row.n - 1] = row["count"]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return [min(float(k), max(LEAST_DISCOUNT, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else LEAST_DISCOUNT for k in (1, 2, 3)]


def fit_model(grams: DataFrame, purpose: str = "kneser-ney") -> DataFrame:
    """Rows (length, hi, lo, logp, back) of an interpolated modified Kneser-Ney model.

    ``logp`` is the log of the interpolated probability of the gram's last character, ``back`` the log of the weight that
    the gram, as a context, gives to the next shorter one; either is null where the gram is not known as that. Below the highest order a count is the
    number of different characters before the gram. Length 0 has the empty context.
    """
    counts = {ORDER: stored(grams, f"{purpose}-counts")}
    for k in range(ORDER - 1, 0, -1):
        hi, lo = ending(F.col("hi"), F.col("lo"), k)
        counts[k] = stored(counts[k + 1].groupBy(hi.alias("hi"), lo.alias("lo")).agg(F.count("*").alias("n")), f"{purpose}-counts")
    lower: DataFrame | None = None
    rows = []
    for k in range(1, ORDER + 1):
        d = discounts(counts[k])
        less = F.element_at(F.array(*map(F.lit, d)), F.least("n", F.lit(3)).cast("int"))
        hi, lo = F.col("hi"), F.col("lo")
        pairs = zip(("context_hi", "context_lo", "suffix_hi", "suffix_lo"), (*before_last(hi, lo), *ending(hi, lo, k - 1)), strict=True)
        at = counts[k].select("hi", "lo", "n", *[c.alias(name) for name, c in pairs], less.alias("less"))
        contexts = stored(at.groupBy("context_hi", "context_lo").agg(F.sum("n").alias("total"), (F.sum("less") / F.sum("n")).alias("weight")), f"{purpose}-contexts")
        base = at.join(contexts, ["context_hi", "context_lo"])
        if lower is None:
            base = base.withColumn("below", F.lit(1.0 / CLASSES))
        else:
            base = base.join(lower.select(hi.alias("suffix_hi"), lo.alias("suffix_lo"), F.col("p").alias("below")), ["suffix_hi", "suffix_lo"])
        lower = stored(base.select("hi", "lo", ((F.col("n") - F.col("less")) / F.col("total") + F.col("weight") * F.col("below")).alias("p")), f"{purpose}-order")
        rows.append(lower.select(F.lit(k).alias("length"), "hi", "lo", F.log("p").alias("logp"), F.lit(None).cast("double").alias("back")))
        rows.append(contexts.select(F.lit(k - 1).alias("length"), F.col("context_hi").alias("hi"), F.col("context_lo").alias("lo"), F.lit(None).cast("double").alias("logp"), F.log("weight").alias("back")))
    out = rows[0]
    for df in rows[1:]:
        out = out.unionByName(df)
    return stored(out.groupBy("length", "hi", "lo").agg(F.max("logp").alias("logp"), F.max("back").alias("back")), f"{purpose}-model")


class Shard:
    """The rows of one shard for lookups: sorted keys of each length, and a direct table for the longest."""

    def __init__(self, model: pa.Table, shard: int, shards: int):
        self.shard, self.shards = shard, shards
        length, hi, lo = (model[c].to_numpy() for c in ("length", "hi", "lo"))
        logp, back = (model[c].to_numpy().astype(np.float32) for c in ("logp", "back"))
        self.keys, self.logp, self.back = [], [], []
        for k in range(ORDER + 1):
            own = np.flatnonzero(length == k)
            keys = keys_of(hi[own], lo[own])
            order = np.argsort(keys)
            self.keys.append(keys[order])
            self.logp.append(logp[own[order]])
            self.back.append(back[own[order]])

    def prepare(self) -> Shard:
        """Fills the direct table; done once in a worker."""
        if not hasattr(self, "slots"):
            size = max(16, (4 * len(self.keys[ORDER])).bit_length())
            self.shift = np.uint64(64 - size)
            self.slots, self.values = np.zeros(1 << size, np.uint64), np.zeros(1 << size, np.float32)
            slot = self.keys[ORDER] >> self.shift
            self.slots[slot], self.values[slot] = self.keys[ORDER], self.logp[ORDER]
        return self

    def score(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The log-probability of the last character of each gram; 0 for grams of other shards."""
        self.prepare()
        keys = keys_of(hi, lo)
        slot = keys >> self.shift
        direct = self.slots[slot] == keys
        out = np.where(direct, self.values[slot], np.float32(0))
        rest = np.flatnonzero(~direct)
        if self.shards > 1:
            rest = rest[shard_of(lo[rest] >> BITS, self.shards) == self.shard]
        for k in range(ORDER, 0, -1):
            gram = ending(hi[rest], lo[rest], k)
            found, at = self._find(k, keys_of(*gram), self.logp)
            out[rest[found]] += self.logp[k][at]
            rest = rest[~found]
            if not len(rest):
                return out
            context = before_last(*ending(hi[rest], lo[rest], k))
            found, at = self._find(k - 1, keys_of(*context), self.back)
            out[rest[found]] += self.back[k - 1][at]
        out[rest] -= np.float32(math.log(CLASSES))
        return out

    def _find(self, k: int, wanted: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys = self.keys[k]
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = (keys[at] == wanted) & ~np.isnan(values[k][at])
        return found, at[found]


def shard_of(before, shards: int):
    """The shard of a gram by the character before its last, in columns or arrays."""
    spread = before * 40503
    return (F.shiftright(spread, 8) if isinstance(before, Column) else spread >> 8) % shards


def score_texts(rows: DataFrame, model: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``rows`` with columns ``logp`` (sum over all characters) and ``chars`` in place of ``text``.

    A shard has all that a character needs whose predecessor is in it, so sums over shards are exact.
    """
    rest = [c for c in rows.columns if c != "text"]
    known = rows.schema
    shards = max(1, math.ceil(model.count() / shard_rows))
    out = rows.withColumns({"logp": F.lit(0.0), "chars": F.lit(0).cast("long")})
    # A context's last character is what stands before the last character of its grams; single characters go to all shards.
    last = F.col("lo").bitwiseAND(LAST)
    middle = F.when(F.col("logp").isNotNull(), F.shiftright("lo", BITS)).otherwise(last)
    for shard in range(shards):
        part = model
        if shards > 1:
            own = lambda c: shard_of(c, shards) == shard
            part = model.where((F.col("length") <= 1) | own(middle) | ((F.col("length") < ORDER) & own(last)))
        shared = rows.sparkSession.sparkContext.broadcast(Shard(part.toArrow(), shard, shards))
        out = out.mapInArrow(_score(shared, rest, shard == shards - 1), out.schema)
    return out.select(*[c for c in known.names if c != "text"], "logp", "chars")


def _score(shared, rest: list[str], last: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            logp, chars = [np.zeros(0)], [np.zeros(0, np.int64)]
            for _, data, bounds in text_chunks(batch.column("text")):
                hi, lo, counts = characters(data, bounds)
                sums = np.concatenate(([0.0], np.cumsum(model.score(hi, lo), dtype=np.float64)))
                ends = np.cumsum(counts)
                logp.append(sums[ends] - sums[ends - counts])
                chars.append(counts)
            done = {"logp": pa.array(np.concatenate(logp) + batch.column("logp").to_numpy()), "chars": pa.array(np.concatenate(chars))}
            if last:
                done["text"] = pa.array([""] * batch.num_rows, batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays([done.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)

    return score


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0


def quality_filter(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", trusted: str = "quality", quantile: float = QUANTILE, margin: float = MARGIN, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row (key, lang, chars, perplexity, threshold, kept, and the columns to ``carry``) per document.

    The model is trained on all documents whose label ``trusted`` is 1, but for a fifth of them (crc32
    of the key mod 5 is 0). ``threshold`` is ``margin`` times the given quantile of perplexity over that fifth, per
    language; a language without any takes the quantile over all. A document is kept if its
    perplexity is not above it; without any trusted document all are kept. Perplexity is per
    character, with ``PRIOR_CHARS`` characters at the mean rate of the language added.

    A null text is empty; an empty or blank text has perplexity null and is not kept. A null language
    is a language of its own. Documents with a null key have no label. Rows with equal keys share their labels and
    are rows of their own; of several labels of a key the highest holds. An empty table gives no rows. Other columns
    are not read.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"), *[F.col(c).alias(f"carried_{c}") for c in carry])
    good = stored(labels.where(F.col(trusted) == 1).select(F.col(key).alias("trusted_id")).distinct(), "quality-trusted")
    marked = rows.join(small_side(good, 8), rows.id == F.col("trusted_id"), "left")
    model = fit_model(count_grams(marked.where(F.col("trusted_id").isNotNull() & ~held_out(F.col("id")))))
    scored = stored(score_texts(marked.withColumn("judge", F.col("trusted_id").isNotNull() & held_out(F.col("id"))).drop("trusted_id"), model), "quality-scored")
    judges = scored.where("judge and chars > 0")
    rates = small_side(stored(judges.groupBy("lang").agg((F.sum("logp") / F.sum("chars")).alias("rate")).withColumnRenamed("lang", "of"), "quality-rates"), 64)
    rate = judges.agg((F.sum("logp") / F.sum("chars")).alias("r")).first().r
    total = F.col("logp") + PRIOR_CHARS * F.coalesce("rate", F.lit(rate).cast("double"), F.col("logp") / F.col("chars"))
    rated = scored.join(rates, scored.lang.eqNullSafe(F.col("of")), "left").withColumn("perplexity", F.when(F.col("chars") > 0, F.exp(-total / (F.col("chars") + PRIOR_CHARS)))).drop("of")
    judged = rated.where("judge and chars > 0")
    at = margin * F.percentile_approx("perplexity", quantile, 10_000)
    limits = small_side(stored(judged.groupBy("lang").agg(at.alias("limit")).withColumnRenamed("lang", "of"), "quality-limits"), 64)
    limit = judged.agg(at.alias("t")).first().t
    out = rated.join(limits, rated.lang.eqNullSafe(F.col("of")), "left").withColumn("threshold", F.coalesce("limit", F.lit(limit).cast("double")))
    kept = (F.col("chars") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select(F.col("id").alias(key), "lang", "chars", "perplexity", "threshold", kept.alias("kept"), *[F.col(f"carried_{c}").alias(c) for c in carry])
