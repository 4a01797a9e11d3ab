"""Texts that are very long, one unbroken run, or full of finds: seconds and a bounded memory, not crashes."""

import time
import tracemalloc

import numpy as np
import pytest

from newslens.llm import language, secrets, surrogates, toxicity


@pytest.fixture(autouse=True)
def within_seconds():
    start = time.process_time()
    yield
    assert time.process_time() - start < 45


def test_constants_joined_over_and_over():
    key = "kT9-xx81Qq_zP4"
    lines = [f'v0 = "{key}"'] + [f"v{i} = v{i - 1} + v{i - 1}" for i in range(1, 3000)]
    tracemalloc.start()
    try:
        base, found = secrets.spans("\n".join([*lines, "client_secret_value = v2999"]))
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()
    assert [(k, b - a) for k, a, b in found if k == "literal"] == [("literal", len(key))]
    assert secrets.spans("\n".join([*lines, "title = v2999"]))[1] == []
    chain = ['v0 = "kT9-xx81Qq_z"'] + [f'v{i} = v{i - 1} + "part{i}"' for i in range(1, 3000)]
    assert len([s for s in secrets.spans("\n".join([*chain, "db_pwd = v2999"]))[1] if s[0] == "literal"]) == 3000


def test_joined_values_are_judged_as_their_text():
    for parts in (["xxx", "XXXX"], ["example", "Q8f-zz1"], ["abc", "defgh1"], ["<q8", "8fzz11>"], ["ab c", "Qq8fzz11"], ["x" * 40, "x" * 40], ["x" * 40, "y", "x" * 40]):
        text = "".join(parts)
        at = np.cumsum([0, *map(len, parts)]).tolist()
        whole = secrets.Value.literal(text, 0, len(text))
        joined = secrets.Value.joined([secrets.Value.literal(text, a, b) for a, b in zip(at, at[1:])])
        assert joined.strength() == whole.strength()
        assert whole.is_placeholder() == bool(secrets.PLACEHOLDER.match(text))


def test_very_many_secrets():
    one = 'api_key = "k%06dQz81xx"\n'
    base, found = secrets.spans("".join(one % i for i in range(100_000)))
    assert len(base) == 100_000 and len(found) == 100_000


def test_an_unbroken_run_and_very_many_entities():
    assert surrogates.detect("a" * 1_000_000) == []
    assert surrogates.detect("A" * 500_000 + " " * 500_000) == []
    text = "".join(f"u{i}@example.com 10.{i % 250}.3.{i % 199} " for i in range(100_000))
    assert len(surrogates.detect(text)) == 200_000


def test_overlapping_entities_keep_the_kind_listed_first():
    text = "call +1 555 123 4567 or 4111 1111 1111 1111, 078-05-1120, a@b.co, 10.0.0.1"
    kinds = [k for _, _, k in surrogates.detect(text)]
    assert kinds == ["phone", "card", "ssn", "email", "ip"]


def test_very_many_insults_and_second_persons():
    text = "you idiot " * 120_000
    values = dict(zip(toxicity.NAMES, toxicity.features(text, {})))
    assert values["near_second"] == values["lexicon_hits"] > 0
    apart = "you " + "w " * 40 + "idiot"
    assert dict(zip(toxicity.NAMES, toxicity.features(apart, {})))["near_second"] == 0


def test_a_text_of_many_megabytes_in_bounded_memory():
    model = language.fit({"en": ["the cat sat on the mat " * 20], "de": ["der Hund lag auf der Matte " * 20]})
    text = "the cat and the dog sat on the mat " * 600_000  # 21 MB
    tracemalloc.start()
    try:
        long = model.lengths([text, "der Hund"])
        assert tracemalloc.get_traced_memory()[1] < 1e9
    finally:
        tracemalloc.stop()
    assert long.argmin(axis=1).tolist() == [list(model.languages).index("en"), list(model.languages).index("de")]
    short = model.lengths(["the cat", text[:300_000], "", "der"])
    assert np.allclose(short[0], model.lengths(["the cat"])[0]) and np.allclose(short[3], model.lengths(["der"])[0]) and not short[2].any()


def test_clashing_columns_of_the_language(spark):
    df = spark.createDataFrame([(1, "the cat", 3.0, "x")] * 2, "doc_id long, text string, score double, lang_pred string")
    model = language.fit({"en": ["the cat sat"], "de": ["der Hund lag"]})
    found = language.predict(df, model, ["doc_id", "score", "lang_pred"])
    assert found.columns == ["doc_id", "score", "lang_pred", "text", "lang_pred_", "score_", "bits"] or found.columns[-3:] == ["lang_pred_", "score_", "bits"]
    assert [r["lang_pred_"] for r in found.collect()] == ["en", "en"]
    assert language.predict(df.limit(0), model, ["doc_id"]).collect() == []
