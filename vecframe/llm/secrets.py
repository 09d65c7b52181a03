"""Secret scan with a ledger of blobs: only DataFrame functions, no Python on the executors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.session import shared_dir


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more. A changed rule gets a new version."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# The patterns and lengths of the three kinds of secrets, in the order in which equal starts are listed.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16),
)

SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule string, version int, spans {SPANS}"


def spans_of(text: Column, rule: Rule) -> Column:
    """(start, end) in code points of the leftmost non-overlapping matches that are long enough.

    What ``split`` leaves between matches and the matches themselves give the places.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    steps = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("match"), measured.alias("measured"))
    start = lambda at, s: at["at"] + F.length(s["gap"])
    end = lambda at, s: start(at, s) + F.coalesce(F.length(s["match"]), F.lit(0))
    step = lambda at, s: F.struct(
        end(at, s).alias("at"),
        F.when(F.length(s["measured"]) >= rule.least, F.concat(at["spans"], F.array(F.struct(start(at, s).alias("start"), end(at, s).alias("end"))))).otherwise(at["spans"]).alias("spans"),
    )
    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(steps, first, step, lambda at: at["spans"])


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All scanned pairs of blob and rule version. A pair that two runs scanned is there twice, with equal spans."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER).parquet(ledger) if there else spark.createDataFrame([], LEDGER)


def update_ledger(versions: DataFrame, ledger: str, *, text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the blobs of ``versions`` that the ledger lacks for any rule version, and append what was found.

    Each distinct text is scanned once, by the rule versions that have not seen it; a blob without findings has rows
    with no spans, so it is not scanned again. Spark commits the appended files together, so a run that fails leaves
    the ledger as it was.
    """
    spark = versions.sparkSession
    wanted = {(r.kind, r.version) for r in rules}
    name = F.concat_ws(":", "rule", "version")
    done = read_ledger(spark, ledger).where(name.isin([f"{k}:{v}" for k, v in wanted])).groupBy("blob").agg(F.collect_set(name).alias("done"))
    blobs = versions.select(blob_of(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    unseen = blobs.join(done, "blob", "left").where(F.coalesce(F.size("done"), F.lit(0)) < len(wanted)) if done.head() else blobs.withColumn("done", F.lit(None).cast("array<string>"))
    once = unseen.groupBy("blob").agg(F.first("text").alias("text"), F.first("done").alias("done"))
    seen = lambda r: F.coalesce(F.array_contains("done", f"{r.kind}:{r.version}"), F.lit(False))
    scanned = once.select(
        "blob", F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), F.when(~seen(r), spans_of(F.col("text"), r)).alias("spans")) for r in rules]).alias("found")
    )
    rows = scanned.select("blob", F.explode("found").alias("f")).select("blob", "f.rule", "f.version", "f.spans").where("spans is not null")
    rows.write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, *, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` without their text, with one array of spans per rule, from the ledger: every path of a blob gets its findings."""
    current = read_ledger(versions.sparkSession, ledger).where(F.concat_ws(":", "rule", "version").isin([f"{r.kind}:{r.version}" for r in rules]) & (F.size("spans") > 0))
    by_blob = current.groupBy("blob").agg(*[F.max(F.when(F.col("rule") == r.kind, F.col("spans"))).alias(r.kind) for r in rules])
    paths = versions.select("*", blob_of(F.col(text)).alias("blob")).drop(text)
    empty = F.array().cast(SPANS)
    return paths.join(by_blob, "blob", "left").withColumns({r.kind: F.coalesce(r.kind, empty) for r in rules})


def scan_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row (key, blob, one array of spans per kind) per document, each document being one version of a path.

    ``ledger`` is a folder that holds what earlier runs scanned; without it a new one in the shared
    folder. A null text is empty. Empty texts have no spans. Rows with equal keys or texts are rows of their own; equal
    texts are scanned once. An empty table gives no rows. Other columns are not read.
    """
    versions = docs.select(F.col(key).alias("path_key"), F.col(text).alias("scanned_text"))
    ledger = ledger or shared_dir(docs.sparkSession, "secret-ledger")
    update_ledger(versions, ledger, text="scanned_text", rules=rules)
    return findings(versions, ledger, text="scanned_text", rules=rules).withColumnRenamed("path_key", key)


def joined_spans(rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of all spans by start, then kind in the order of the rules, comma-joined."""
    marked = [F.transform(rule.kind, _marked(i, rule.kind)) for i, rule in enumerate(rules)]
    return F.array_join(F.transform(F.array_sort(F.concat(*marked)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _marked(number: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind"))
