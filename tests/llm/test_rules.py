import re

import pytest

import __spark_entry__ as entry
from newslens.llm import quality_rules
from newslens.llm.queries import ORACLES, QUERIES
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


def plain(text):
    """The base counts, word by word."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


PROSE = " ".join(f"word{i}, other{i * 7}." for i in range(60))
TEXTS = [
    None, "", " \n\t", "a", "a b c a b c", "a b c d a b c", "x x x x x x", "one\ntwo\none\n\none \n one", "日本 語\x0bé ñ|<", "tab\tword\x0cnext\rline",
    PROSE, PROSE + "\nLicensed under CC BY 4.0.", "Home | About | Menu | Login\n" + PROSE, PROSE + "\n" + "SHOUT!! " * 100, "a | b | c | d\n" * 30,
    " ".join(f"w{i}###" for i in range(80)), " ".join(f"w{i}" for i in range(80)), "w " * 30000,
]


def test_counts_equal_the_plain_ones(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, kept int, words string")
    rows = quality_rules.apply_rules(df).select("doc_id", "text", "kept", "_rules").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        x = r._rules
        if r.doc_id != len(TEXTS) - 1:
            assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == plain(r.text), r.text[:40]
        else:
            assert (x.n_words, x.n_repeat_words, x.base_failed) == (30000, 30000, True)
        assert not (x.base_failed and x.kept)
    kept = {r.doc_id for r in rows if r._rules.kept}
    assert kept == {10, 11, 12}
    cleaned = {r.doc_id: r._rules.cleaned for r in rows}
    assert cleaned[11] == PROSE and cleaned[12] == PROSE and cleaned[10] == PROSE
    assert quality_rules.apply_rules(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op9_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), ORACLES[name]) == ""
