import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecframe.functions import text as texts
from vecframe.functions.encoders import HashEncoder, PooledEncoder, embed


def brute_tokens(text):
    found, word = [], ""
    for c in unicodedata.normalize("NFD", text.lower()):
        kind = unicodedata.category(c)
        mark = kind[0] == "P" or (33 <= ord(c) < 127 and not c.isalnum())
        if kind == "Mn" or c == "�" or (kind[0] == "C" and c not in "\t\n\r"):
            continue
        if mark or c in "\t\n\r" or kind == "Zs":
            found += [word] if word else []
            found += [c] if mark else []
            word = ""
        else:
            word += c
    return found + ([word] if word else [])


def brute_pieces(text, ids):
    out = [ids["[CLS]"]]
    for word in brute_tokens(text):
        parts, at = [], 0
        while at < len(word) <= 100:
            for end in range(len(word), at, -1):
                piece = ("##" if at else "") + word[at:end]
                if piece in ids:
                    parts.append(ids[piece])
                    at = end
                    break
            else:
                break
        out += parts if at == len(word) else [ids["[UNK]"]]
    return (out + [ids["[SEP]"]])[:256]


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(4)
    pool = [chr(i) for i in (*range(1, 0x250), *range(0x300, 0x320), 0x2028, 0x2029, 0x2003, 0x3000, 0x200B, 0xFEFF, 0xFFFD)]
    pool += list("€—İΣσςß中가ำ©™😀") + [" "] * 150
    data = ["".join(rng.choice(pool) for _ in range(80)) for _ in range(1500)]
    data += ["", " ", "plain words, only.", "ΑΣ ΟΔΟΣ.", "x" * 101 + " " + "y" * 100, "word " * 400, "a b"]
    return spark.createDataFrame(list(enumerate(data)), "i int, t string").persist(), data


def column(df, expression):
    return {r.i: r.out for r in df.select("i", expression.alias("out")).collect()}


def test_tokens(awkward):
    df, data = awkward
    got = column(df, texts.basic_tokens(F.col("t")))
    assert [i for i, t in enumerate(data) if got[i] != brute_tokens(t)] == []


def test_wordpieces(awkward):
    df, data = awkward
    letters = sorted({c for t in data[::2] for w in brute_tokens(t) for c in w})
    vocabulary = [*texts.SPECIAL_TOKENS, *letters, *["##" + c for c in letters[::3]], "word", "pl", "##ain", "y" * 100]
    got = column(df, texts.wordpiece_ids(F.col("t"), vocabulary))
    ids = {piece: i for i, piece in enumerate(vocabulary)}
    assert [i for i, t in enumerate(data) if got[i] != brute_pieces(t, ids)] == []
    assert len(got[data.index("word " * 400)]) == 256 and got[data.index("word " * 400)][-1] == ids["word"]
    with pytest.raises(ValueError):
        texts.wordpiece_ids(F.col("t"), ["[CLS]", "[SEP]"])


@pytest.mark.parametrize("limit", [texts.BROADCAST_BYTES, 0])
def test_wordpieces_of_a_vocabulary_table(spark, awkward, limit):
    """With 0 nothing is small: the vocabulary is joined by shuffle, and only very frequent tokens travel."""
    df, data = awkward
    letters = sorted({c for t in data[::2] for w in brute_tokens(t) for c in w})
    pieces = [*texts.SPECIAL_TOKENS, *letters, *["##" + c for c in letters[::3]], "word", "pl", "##ain", "y" * 100]
    ids = {piece: i for i, piece in enumerate(pieces)}
    vocabulary = spark.createDataFrame(list(ids.items()), "piece string, id int")
    extra = spark.createDataFrame([(-1, None), (-2, "plain word"), (-2, "plain word")], "i int, t string")
    got = texts.wordpiece_join(df.unionByName(extra), vocabulary, key="i", text="t", broadcast_limit=limit).collect()
    wanted = [(i, brute_pieces(t, ids)) for i, t in enumerate(data)] + [(-1, [2, 3])] + 2 * [(-2, brute_pieces("plain word", ids))]
    assert sorted((r.i, r.ids) for r in got) == sorted(wanted)
    with pytest.raises(ValueError, match="lacks"):
        texts.wordpiece_join(df, vocabulary.where("piece <> '[UNK]'"), key="i", text="t")


def test_titles(awkward):
    df, data = awkward
    plain = lambda t: re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t.lower())).strip()
    got = column(df, texts.normalize_title(F.col("t")))
    assert [i for i, t in enumerate(data) if got[i] != plain(t)] == []
    stripped = column(df, texts.strip_text(F.col("t")))
    assert [i for i, t in enumerate(data) if stripped[i] != t.strip()] == []


def test_null_title(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(texts.normalize_title(F.col("t"))).first()[0] == ""


def brute_truncate(text):
    if len(text) <= 800:
        return text
    cut = text[:800]
    space = cut.rfind(" ")
    return (cut[:space] if space > 700 else cut) + " …"


def test_truncation(spark):
    data = ["a" * 800, "a" * 801, *("a" * n + " " + "b" * 900 for n in (0, 699, 700, 701, 702, 798, 799, 800)), "é😀 " * 400]
    df = spark.createDataFrame(list(enumerate(data)), "i int, t string")
    got = column(df, texts.truncate_text(F.col("t")))
    assert [got[i] for i in range(len(data))] == [brute_truncate(t) for t in data]


PROMPTS = ["a hobbit destroys a magic ring", "a heist crew steals from a casino"]


def test_hash_encoder(spark):
    df = spark.createDataFrame([(0, PROMPTS[0]), (1, PROMPTS[1]), (2, PROMPTS[0]), (3, ""), (4, None)], "i int, t string")
    got = {r.i: np.array(r.vector) for r in embed(df, "t", HashEncoder()).collect()}
    assert all(len(v) == 384 for v in got.values())
    assert abs(np.linalg.norm(got[0]) - 1) < 0.01 and (got[0] == got[2]).all()
    assert got[0] @ got[1] < 0.5 and not got[3].any() and not got[4].any()


def test_pooled_encoder_hosts_a_model(spark):
    vocabulary = [*texts.SPECIAL_TOKENS, "a", "b", "c"]
    table = np.eye(len(vocabulary))

    def load():
        return lambda ids, mask: table[ids]

    df = spark.createDataFrame([(0, "a a b"), (1, "c"), (2, "")], "i int, t string")
    got = {r.i: np.array(r.vector) for r in embed(df, "t", PooledEncoder(vocabulary, load, dimension=7, batch=2)).collect()}
    for i, pieces in enumerate([[2, 4, 4, 5, 3], [2, 6, 3], [2, 3]]):
        mean = table[pieces].mean(axis=0)
        assert got[i] == pytest.approx(mean / np.linalg.norm(mean), abs=1e-6)
