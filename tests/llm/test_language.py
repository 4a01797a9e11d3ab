import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from newslens.llm import language
from newslens.llm.common import held_out

SAMPLES = {
    "aa": ["the cat sat on the mat", "then the other cat", "é the"],
    "bb": ["le chat est sur le tapis", "et puis un autre chat", "été"],
}


def plain_bits(samples, text):
    """The code length by dictionaries, byte by byte."""
    counts = [Counter() for _ in range(language.ORDER + 1)]
    for t in samples:
        raw = language.START + t.encode()
        for i in range(language.ORDER, len(raw)):
            for k in range(language.ORDER + 1):
                counts[k][raw[i - k : i + 1]] += 1
    raw, bits = language.START + text.encode(), 0.0
    for i in range(language.ORDER, len(raw)):
        for k in range(language.ORDER, -2, -1):
            if k < 0:
                bits += 8
                break
            context = raw[i - k : i]
            followers = {g: n for g, n in counts[k].items() if g[:-1] == context}
            if not followers:
                continue
            total, different = sum(followers.values()), len(followers)
            if n := followers.get(context + raw[i : i + 1]):
                bits -= math.log2(n / (total + different))
                break
            bits -= math.log2(different / (total + different))
    return bits


def test_code_lengths_equal_the_plain_ones():
    model = language.fit(SAMPLES)
    texts = ["the cat", "un chat noir", "zzz", "é", "x" * 300, "the\nmat 日本"]
    got = model.lengths(texts)
    for t, row in zip(texts, got, strict=True):
        for name, bits in zip(model.languages, row, strict=True):
            assert abs(bits - plain_bits(SAMPLES[name], t)) < 1e-3 * (1 + len(t))


def test_prediction_and_edges(spark):
    model = language.fit(SAMPLES)
    rows = [(1, None, "k"), (2, "", "k"), (3, "123 ...", "k"), (4, "the cat on the mat", "k"), (4, "the cat on the mat", "k"), (None, "le chat sur le tapis", "k"), (6, "the cat " * 30000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = sorted([tuple(r) for r in language.predict(df, model, ["doc_id"]).collect()], key=lambda r: (r[0] is None, r[0] or 0))
    assert [r[1] for r in got] == ["und", "und", "und", "aa", "aa", "aa", "bb"]
    assert [r[2] for r in got[:3]] == [0, 0, 0] and all(0.5 <= r[2] <= 1 for r in got[3:])
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert language.sample(unlabelled, F.lit(True)) == {}
    assert {r.lang_pred for r in language.predict(df, language.fit({}), ["doc_id"]).collect()} == {"und"}
    assert language.predict(df.limit(0), model, ["doc_id"]).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = held_out("doc_id", 4, 2)
    model = language.fit(language.sample(docs, ~fold))
    got = language.predict(docs.withColumn("held_out", fold), model, ["doc_id", "held_out"]).filter("held_out").join(docs, "doc_id")
    right, n = got.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right / n > 0.98
    assert np.isfinite(right)
