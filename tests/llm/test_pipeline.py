"""The stages of the pipeline, each on what the one before kept, against brute force."""

from collections import Counter, defaultdict

import pytest
from test_near import joined, similar_pairs, word_set
from test_text_ops import WHITE, leaks, targets_of

import corpus_pipeline
from vecframe.llm.common import table
from vecframe.llm.quality import quality_filter
from vecframe.llm.queries import VOCABULARY
from vecframe.llm.token_shards import encoder

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def kept(spark, small, tmp_path_factory):
    """What each stage has kept, and the last stage's rows."""
    docs, out = table(spark, small, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def facts(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect())


def test_stages_return_the_columns_of_documents(spark, small, kept):
    wanted = dict(table(spark, small, "documents").dtypes)
    assert all(dict(df.dtypes) == wanted for df in kept[:-1])


def test_quality_drops_what_the_classifier_rejects(spark, small, kept):
    docs = table(spark, small, "documents")
    good = {r.doc_id for r in quality_filter(docs, table(spark, small, "labels")).where("kept").collect()}
    assert facts(kept[0]) == Counter({k: n for k, n in facts(docs).items() if k[0] in good}) and 0 < len(good) < docs.count()


def test_one_document_of_each_group_stays(kept):
    rows = sorted(facts(kept[0]).elements())
    root = joined(similar_pairs([word_set(r[1]) for r in rows]), len(rows))
    assert facts(kept[1]) == Counter(rows[i] for i in range(len(rows)) if root[i] == i)
    assert facts(kept[1]).total() < len(rows)


def test_leaking_documents_go(spark, small, kept):
    items = [r.text for r in table(spark, small, "benchmark").collect()]
    assert facts(kept[2]) == Counter({k: n for k, n in facts(kept[1]).items() if not any(leaks(k[1], item) for item in items)})


def test_sources_take_their_targets(kept):
    size = lambda t: len(WHITE.findall(t or ""))
    before, sizes = {}, defaultdict(int)
    for doc, text, _, source, _ in facts(kept[2]).elements():
        before[doc] = text
        sizes[source] += size(text)
    taken, cut = Counter(), Counter()
    for doc, text, _, source, n_chars in facts(kept[3]).elements():
        taken[source] += size(text)
        if text != before[doc]:
            cut[source] += 1
            assert before[doc].startswith(text) and n_chars == len(text)
    assert all(n == 1 for n in cut.values())
    assert all(abs(taken[s] - t) <= 1 for s, t in targets_of(sizes).items())


def test_all_tokens_are_written(kept):
    with open(VOCABULARY, "rb") as file:
        enc = encoder(file.read())
    tokens = sum(len(enc.encode_ordinary(r.text)) + 1 for r in kept[3].collect())
    rows = kept[4].collect()
    assert sum(r.n_tokens for r in rows) == tokens and sorted(r.slot for r in rows) == list(range(len(rows)))


def test_rows_that_are_equal_or_null(spark, small):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, text, "en", "a", 9), (1, text, "en", "a", 9), (2, text + " x", None, None, None), (None, None, "en", "a", 0), (None, "", None, None, None), (3, "one two", "en", "a", 7)]
    docs = spark.createDataFrame(rows, COLUMNS)
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.near_duplicates(spark, docs, small).collect()) == [0, 0, 1, 3]
    assert corpus_pipeline.decontaminated(spark, docs, small).count() == 6
    words = sum(len(WHITE.findall(r.text or "")) for r in corpus_pipeline.mixed(spark, docs, small).collect())
    assert abs(words - 93) <= 2
    assert corpus_pipeline.quality(spark, docs, small).where("text is null or text = ''").count() == 0
    empty = docs.limit(0)
    assert all(stage(spark, empty, small).count() == 0 for _, stage in corpus_pipeline.STAGES)
