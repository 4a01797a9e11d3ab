"""Search against a plain BM25."""

import math
import re
import time
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newslens.functions import inverted
from newslens.operators import search as ops
from newslens.plans.storage import CLEANUP, scratch_path

DOCS = [
    ("1", "Fake news spreads", "the fake story about news and more news", 1),
    ("2", "Quiet day", "no news is good news", 0),
    ("3", "Élections 2024", "Les élections; fakes et news", 1),
    ("4", "", "fake fake fake fake", 0),
    ("5", "Weather", None, 0),
    ("6", "fake", "", 1),
]


@pytest.fixture(scope="module")
def articles(spark):
    rows = [(i, t, b, f, 0.5, 0.9, "s", "en", "u", datetime(2024, 1, 1)) for i, t, b, f in DOCS]
    columns = "id string, title string, body string, is_fake int, p_fake double, confidence double, source string, language string, url string"
    return spark.createDataFrame(rows, columns + ", processed_at timestamp")


def tokens(s):
    return re.findall(r"[^\W_]+", (s or "").lower())


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(query, fuzzy):
    fields = {(i, f): tokens(v) for i, t, b, _ in DOCS for f, v in (("title", t), ("body", b))}
    fields = {k: v for k, v in fields.items() if v}
    best = {}
    for (i, f), words in fields.items():
        peers = [w for (_, g), w in fields.items() if g == f]
        average, total = sum(map(len, peers)) / len(peers), 0.0
        for term, tf in Counter(words).items():
            weight = 0.0
            for q in tokens(query):
                most = (0 if len(q) <= 2 else 1 if len(q) <= 5 else 2) if fuzzy else 0
                d = edit(term, q)
                if d <= most:
                    weight += 1 - d / min(len(term), len(q))
            df = sum(term in w for w in peers)
            idf = math.log(1 + (len(peers) - df + 0.5) / (df + 0.5))
            total += weight * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average))
        if total:
            best[i] = max(best.get(i, 0), total * (3 if f == "title" else 1))
    return best


@pytest.mark.parametrize("query", ["fake", "news fake", "fake fake news", "ÉLECTIONS, news!", "absent"])
@pytest.mark.parametrize("fuzzy", [False, True])
def test_scores(articles, query, fuzzy):
    got = {r.id: r.score for r in ops.score_hits(ops.build_index(articles), query, fuzzy).collect()}
    want = brute(query, fuzzy)
    assert got.keys() == want.keys()
    for i, score in want.items():
        assert got[i] == pytest.approx(score, abs=1e-9)


@pytest.mark.parametrize("query", ["elections", "fakee weathr", "nws"])
def test_fuzzy(articles, query):
    got = {r.id: r.score for r in ops.score_hits(ops.build_index(articles), query, fuzzy=True).collect()}
    assert got == pytest.approx(brute(query, True), abs=1e-9) and got


def test_allowed_edits():
    assert [ops.allowed_edits("x" * n) for n in (1, 2, 3, 5, 6, 9)] == [0, 0, 1, 1, 2, 2]


def test_filter_limit_total_and_order(articles):
    index = ops.build_index(articles)
    found = ops.search(index, articles, "fake news", 2, is_fake=1).collect()
    want = brute("fake news", False)
    fakes = [i for i, _, _, f in DOCS if f and i in want]
    assert [r.id for r in found] == sorted(fakes, key=lambda i: -round(want[i], 6))[:2]
    assert ops.total_hits(index, "fake news").first().total == len(want)
    assert [r["rank"] for r in ops.ranked_scores(ops.search(index, articles, "news")).orderBy("rank").collect()] == [1, 2, 3]


def test_a_stored_index_finds_the_same(spark, articles):
    index = ops.build_index(articles)
    kept = ops.store_index(index, scratch_path(spark, "test-index"))
    for query, fuzzy in (("fake news", False), ("fakes nws", True), ("absent", False)):
        want = sorted(tuple(r) for r in ops.score_hits(index, query, fuzzy).collect())
        assert sorted(tuple(r) for r in ops.score_hits(kept, query, fuzzy).collect()) == want
    assert ops.search(kept, articles, "fake news", 3).collect() == ops.search(index, articles, "fake news", 3).collect()
    with pytest.raises(AnalysisException):
        ops.search(kept, articles.drop("url"), "fake news")


def test_limits(articles):
    index = ops.build_index(articles)
    with pytest.raises(ValueError):
        ops.search(index, articles, "x")
    with pytest.raises(ValueError):
        ops.search(index, articles, "fake", 101)


def test_stored_postings_are_pruned_by_term(spark, articles):
    kept = ops.store_index(ops.build_index(articles), scratch_path(spark, "test-index"))
    plan = ops._hits(kept, Counter({"fake": 1}), False)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line and re.search(r"term#\d+ = fake|term#\d+ IN \(fake", line)]
    assert len(filters) >= 2, plan  # postings and dictionary
    fuzzy = ops._hits(kept, Counter({"fake": 1}), True)._jdf.queryExecution().executedPlan().toString()
    assert "levenshtein" in fuzzy


def test_a_stored_index_tokenises_once_and_deals_lists_not_postings(spark, monkeypatch):
    rows = [(n, "Hot common", " ".join(["hot", f"w{n % 7}", "hot"][: n % 4])) for n in range(600)] + [(None, "hot éß", "名 hot")]
    df = spark.createDataFrame(rows, "id int, title string, body string").repartition(2)
    index, dealt = ops.build_index(df), []
    monkeypatch.setattr(ops, "by_term", lambda lists, put=ops.by_term: dealt.append(lists.count()) or put(lists))
    kept = ops.store_index(index, scratch_path(spark, "test-index"))
    facts = lambda df: sorted(map(repr, df.select("id", "field", "term", "tf", "dl").collect()))
    assert facts(kept.postings) == facts(index.postings) and kept.postings.count() > 1900
    assert 1900 > dealt[0] * 20  # rows that the sort by term moves
    assert sorted(map(repr, kept.lengths.collect())) == sorted(map(repr, index.lengths.collect()))
    assert sorted(map(repr, kept.terms.select("field", "term", "df").collect())) == sorted(map(repr, ops.dictionary(index.postings).collect()))
    assert "id" in kept.postings.columns and kept.postings.schema["id"].dataType == df.schema["id"].dataType


@pytest.mark.parametrize("part, merged", [(1 << 21, 1 << 23), (300, 1 << 23), (300, 150)])
def test_postings_are_whole_in_any_number_of_parts(spark, monkeypatch, part, merged):
    monkeypatch.setattr(inverted, "PART", part)
    monkeypatch.setattr(inverted, "STEP", 20)
    monkeypatch.setattr(inverted, "ROWS", 100)
    monkeypatch.setattr(inverted, "MERGED", merged)
    rows = [(n, "hot éß" if n % 3 else None, " ".join(["hot"] * (n % 300) + [f"w{n % 7}", "名", f"x{n}"])) for n in range(400)] + [(None, "hot", "w1"), (7, "hot", "")]
    df = spark.createDataFrame(rows, "id long, title string, body string").repartition(3)
    index = ops.build_index(df)
    cuts = inverted.bounds(index.fields)
    assert (len(cuts) > 20) == (part == 300) and cuts == sorted(cuts)
    kept = ops.store_index(index, scratch_path(spark, "test-index"))
    facts = lambda df: sorted(map(repr, df.select("id", "field", "term", "tf", "dl").collect()))
    assert facts(kept.postings) == facts(index.postings) and kept.postings.dtypes == index.postings.dtypes
    assert sorted(map(repr, kept.terms.collect())) == sorted(map(repr, ops.dictionary(index.postings).select(*kept.terms.columns).collect()))
    if merged > part > 1000 or part == 300 < merged:
        files = kept.postings.select(F.input_file_name().alias("f"), F.struct("term", "field", F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("k")).groupBy("f").agg(F.min("k").alias("low"), F.max("k").alias("high"))
        spans = sorted((tuple(r.low), tuple(r.high)) for r in files.collect())
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and (len(spans) > 20) == (part == 300)


def test_a_stored_index_leaves_no_shuffle_files(spark, articles):
    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "/shuffle_" in f}

    before, setting = left(), spark.conf.get(CLEANUP, None)
    ops.store_index(ops.build_index(articles.repartition(3)), scratch_path(spark, "test-index"))
    mine = lambda: {f for f in left() - before if f.endswith(".data")}
    for _ in range(50):
        if not mine():
            break
        time.sleep(0.2)
    assert not mine() and spark.conf.get(CLEANUP, None) == setting
