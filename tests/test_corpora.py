"""Corpus files of all kinds, cleaning, dedup and split."""

import math
from collections import Counter

import pytest

from newslens.operators import corpus as ops
from newslens.sources import corpora


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")
    return str(path)


def liar_line(label, statement, context, extra=""):
    return "\t".join(["1.json", label, statement, *["x"] * 10, context]) + extra + "\n"


@pytest.fixture
def base(tmp_path):
    put(tmp_path / "welfake/WELFake_Dataset.csv", ',title,text,label\n0,"A, ""quoted"" title","two\nlines",1\n1,,no title here,0\n2,Second title,,0\n')
    put(tmp_path / "isot/Fake.csv", "title,text,subject,date\nfake one,body,s,d\n")
    put(tmp_path / "isot/True.csv", "title,text,subject,date\nreal one,body,s,d\n")
    put(tmp_path / "liar/train.tsv", liar_line("half-true", "stated é", "ctx") + liar_line("pants-fire", "", "") + liar_line("true", "bad", "c", "\textra") + liar_line("true", "bad2", "c", "\t"))
    put(tmp_path / "fakenewsnet/dataset/gossipcop_fake.csv", "id,news_url,Title_Text,tweets\n1,u1,gossip,9\n2,u2,bad,9,9\n3,u3\n")
    put(tmp_path / "fakenewsnet/dataset/politifact_real.csv", "id,url\n1,u\n")
    return tmp_path


def test_every_reader(spark, base):
    got = ops.build_corpus(corpora.read_base(spark, str(base))).drop("corpus_order").collect()
    assert Counter(tuple(r) for r in got) == Counter([
        ('A, "quoted" title', "two\nlines", 1, "welfake"),
        ("Second title", None, 0, "welfake"),
        ("fake one", "body", 1, "isot"),
        ("real one", "body", 0, "isot"),
        ("stated é", "ctx", 0, "liar"),
        ("", "", 1, "liar"),
        ("gossip", "u1", 1, "fakenewsnet"),
    ])


def test_a_pair_counts_only_when_complete(spark, tmp_path):
    put(tmp_path / "isot/Fake.csv", "title,text\nx,y\n")
    assert corpora.read_base(spark, str(tmp_path)) == []
    with pytest.raises(ValueError):
        ops.build_corpus([])


def test_surplus_fields_are_an_error_unless_skipped(spark, tmp_path):
    path = put(tmp_path / "a.csv", "title,text\nx,y\np,q,r\n")
    assert corpora.read_corpus_csv(spark, path, skip_bad=True).count() == 1
    with pytest.raises(Exception, match="more fields"):
        corpora.read_corpus_csv(spark, path).collect()


def test_clean_and_dedup_keep_the_first(spark):
    rows = [(1, "Same   title", "a", 1, 1), (0, "Same title", "b", 0, 2), (2, "tiny", "c", 0, 3), (3, "123456", "d", 0, 4), (4, None, "e", 0, 5)]
    df = spark.createDataFrame(rows, "pos int, title string, body string, label int, n int")
    cleaned = ops.clean_corpus(df)
    assert {r.title for r in cleaned.collect()} == {"Same title", "123456"}
    kept = {r.title: r.body for r in ops.dedup_title(cleaned, ["pos"]).collect()}
    assert kept == {"Same title": "b", "123456": "d"}
    assert ops.dedup_report(cleaned).first().asDict() == {"rows_before": 3, "rows_after": 2, "removed": 1}


@pytest.mark.parametrize("counts", [(700, 300), (37, 5), (100, 1), (10, 10)])
def test_split_sizes_and_writing(spark, tmp_path, counts):
    rows = [(f"{lb}-{i}", f"title {lb} {i}", "b", lb, "s") for lb, n in enumerate(counts) for i in range(n)]
    df = spark.createDataFrame(rows, "id string, title string, body string, label int, source string")
    got = ops.stratified_split(df)
    n = sum(counts)
    kept = n - math.ceil(n * 0.10)
    val = math.ceil(kept * 0.111)
    sizes = Counter(r.split for r in got.collect())
    assert (sizes["test"], sizes["val"], sizes["train"]) == (n - kept, val, kept - val)
    assert got.select("id").distinct().count() == n
    for label, whole in enumerate(counts):
        share = got.filter(f"label = {label} and split = 'test'").count()
        assert abs(share - whole * (n - kept) / n) < 1
    corpora.write_splits(got, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert Counter(r.split for r in back.collect()) == sizes


def test_split_does_not_depend_on_partitions(spark):
    rows = [(str(i), i % 3 == 0) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, l boolean").selectExpr("id", "cast(l as int) as label")
    one = ops.stratified_split(df.coalesce(1)).collect()
    many = ops.stratified_split(df.repartition(7)).collect()
    assert sorted(one) == sorted(many)
