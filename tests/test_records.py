"""Files with line breaks inside quotes, read in parts, against the reader of whole files."""

import random

import pytest
from pyspark.sql import types as T

from newslens.operators import corpus
from newslens.sources import corpora, records

COLUMNS = ("title", "text", "label")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (*COLUMNS, "_surplus", "_odd")])


def field(draw, sep):
    letters = lambda n: "".join(draw.choice(f'ab {sep}"\né') for _ in range(n))
    return draw.choice([
        lambda: '"' + letters(draw.randrange(12)).replace('"', '""') + '"', lambda: "", lambda: '5" wide', lambda: '""',
        lambda: '"' + "line\n" * draw.randrange(1, 40) + '"', lambda: "plain é", lambda: f'"{sep}""{sep}"',
    ])()


@pytest.fixture(params=["128m", "3k", "500"])
def split_size(spark, request):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("sep", [",", "\t"])
def test_equals_the_reader_of_whole_files(spark, tmp_path, split_size, sep):
    draw = random.Random(split_size + sep)
    path = tmp_path / "x.csv"
    rows = "".join(f"{i}{sep}{field(draw, sep)}{sep}{field(draw, sep)}\n" + "\n" * (i % 50 == 0) for i in range(800))
    path.write_text(sep.join(COLUMNS) + "\n" + rows + f'800{sep}"last"{sep}no line break')
    options = corpora._QUOTING
    want = spark.read.schema(SCHEMA).options(**options, sep=sep, header=True, multiLine=True).csv(str(path)).collect()
    got = records.read_records(spark, [str(path)], SCHEMA, options, sep=sep, header=True)
    assert sorted(map(str, got.drop(*records.PLACE).collect())) == sorted(map(str, want)) and len(want) == 801
    placed = sorted((r["_record"], r["title"]) for r in got.collect())
    assert placed == [(i + 2, str(i)) for i in range(801)]
    scanned = spark.read.text(str(path)).rdd.getNumPartitions()
    assert scanned > 5 if split_size == "500" else scanned >= 1


def test_the_same_title_survives_under_any_split(spark, tmp_path, split_size):
    folder = tmp_path / "welfake"
    folder.mkdir()
    lines = [f'{i},title {i % 40},"text\n{i}, of it",{i % 2}' for i in range(400)]
    (folder / "WELFake_Dataset.csv").write_text("id,title,text,label\n" + "\n".join(lines) + "\n")
    frames = corpora.read_base(spark, str(tmp_path))
    built = corpus.build_corpus(frames)
    assert built.columns == [*corpora.CORPUS_COLUMNS, "corpus_order"]
    kept = corpus.dedup_title(built, ["corpus_order"])
    assert {r.title: r.body for r in kept.collect()} == {f"title {i}": f"text\n{i}, of it" for i in range(40)}


def test_carriage_returns_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'title,text\r\n"x\r\ny",1\r\nz,2\r\n')
    (tmp_path / "b.csv").write_bytes(b"")
    (tmp_path / "c.csv").write_bytes(b"title,text\r\n")
    found = corpora.read_corpus_csv(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv")])
    assert sorted((r.title, r.text) for r in found.collect()) == [("x\r\ny", "1"), ("z", "2")]
