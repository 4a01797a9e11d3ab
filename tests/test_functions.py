"""Column expressions against hand-made values."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from newslens.functions import scores, text


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {schema}").select("i", column.alias("o")).orderBy("i").select("o").collect()]


def test_sanitise(spark):
    got = values(spark, [float("nan"), float("inf"), -float("inf"), None, -0.5, 1.5, 0.8], "double", scores.sanitise(F.col("v")))
    assert got == [0.5, 0.5, 0.5, 0.5, 0.0, 1.0, 0.8]


def test_safe_tone(spark):
    got = values(spark, [None, "", "abc", "-2.5", "3", "3d", " 4.5 "], "string", scores.safe_tone(F.col("v")))
    assert got == [0.0, 0.0, 0.0, -2.5, 3.0, 0.0, 4.5]
    assert values(spark, [3], "int", scores.safe_tone(F.col("v"))) == [3.0]


def test_composite_takes_only_eight_values(spark):
    votes = spark.createDataFrame([(bool(i & 1), bool(i & 2), bool(i & 4)) for i in range(8)], "a boolean, k boolean, p boolean")
    got = votes.select(scores.composite(F.col("a"), F.col("k"), F.col("p")).alias("c"))
    assert sorted(round(r.c, 4) for r in got.collect()) == [0.0, 0.2, 0.35, 0.45, 0.55, 0.65, 0.8, 1.0]
    assert votes.filter("a and k and not p").select((scores.composite(F.col("a"), F.col("k"), F.col("p")) >= 0.8).alias("c")).first().c


def _clean(s):
    if s is None:
        return ""
    s = re.sub(r"http\S+", "[URL]", s)
    s = re.sub(r"@\w+", "[USER]", s)
    for a, b in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        s = s.replace(a, b)
    return re.sub(r"\s+", " ", s).strip()[:2000]


def test_clean_text(spark):
    rows = [
        None, "", "  a\t b c\n", "see https://x.org/a?b=1 now", "hi @élodie_9 and @bob", "x &amp;lt; y &gt; z",
        "é" * 2100, "a b\u0085c\x1cd", "http://a.b c", "@useŕ x", "tag @", "&amp;amp;",
    ]
    got = values(spark, rows, "string", text.clean_text(F.col("v")))
    assert got == [_clean(r) for r in rows]


def test_model_inputs_shorten_differently(spark):
    row = spark.createDataFrame([("t" * 300, "b" * 300), ("x", None)], "t string, b string")
    score = [r[0] for r in row.select(text.score_text(F.col("t"), F.col("b"))).collect()]
    train = [r[0] for r in row.select(text.train_text(F.col("t"), F.col("b"))).collect()]
    assert score == ["t" * 200 + " [SEP] " + "b" * 100, "x [SEP] "]
    assert train == ["t" * 300 + " [SEP] " + "b" * 100, "x [SEP] "]


def test_content_id(spark):
    row = spark.createDataFrame([("u", "é"), (None, "t"), ("u", None)], "u string, t string")
    got = [r[0] for r in row.select(text.content_id(F.col("u"), F.col("t"))).collect()]
    assert got == [hashlib.md5(s.encode()).hexdigest() for s in ("ué", "t", "u")]


def test_liar_label(spark):
    got = values(spark, ["true", " mostly-true ", "half-true", "false", "pants-fire", None, "True"], "string", text.liar_label(F.col("v")))
    assert got == [0, 0, 0, 1, 1, 1, 1]


def test_words(spark):
    (got,) = values(spark, ["Hello, WORLD! (l'été) don't ''x''"], "string", text.words(F.col("v")))
    want = [w.strip(text.EDGE_PUNCTUATION).replace("'", "") for w in "hello, world! (l'été) don't ''x''".split()]
    assert got == want


@pytest.mark.parametrize("a,b", [(0.0, 0.0), (1.0, 2.0), (900.0, -900.0), (-3.0, 5.0)])
def test_from_logits(spark, a, b):
    r = spark.range(1).select(scores.from_logits(F.array(F.lit(a), F.lit(b))).alias("s")).first().s
    p = 1 / (1 + math.exp(min(a - b, 700)))
    assert r.label == int(b > a)
    assert r.p_fake == pytest.approx(p, abs=1e-12)
    assert r.confidence == pytest.approx(max(p, 1 - p), abs=1e-12)


def test_bands_and_maps(spark):
    assert values(spark, [None, 19.9, 20.0, 59.0, 60.0], "double", scores.band(F.col("v"), scores.FAKE_RATE_BANDS)) == [None, "green", "yellow", "orange", "red"]
    assert values(spark, [0.69, 0.7, 0.9], "double", scores.band(F.col("v"), scores.CONFIDENCE_BANDS)) == ["red", "yellow", "green"]
    assert values(spark, [0, 1, None], "int", scores.value_map(F.col("v"), scores.DRIFT_ACTIVE_LABELS)) == ["NON", "OUI", None]
    assert values(spark, ["critical", "warning", "info"], "string", scores.value_map(F.col("v"), scores.SEVERITY_RANK, 0)) == [2, 1, 0]
