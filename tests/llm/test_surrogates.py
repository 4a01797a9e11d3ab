import random
import re

import pytest

from newslens.llm import surrogates as s

KEY = b"k" * 32


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 97, 500])
def test_a_permutation_that_moves_everything(n):
    to = [s.moved(KEY, "t", x, n) for x in range(n)]
    assert sorted(to) == list(range(n)) and (n == 1 or all(a != b for a, b in enumerate(to)))
    assert n < 90 or to != [s.moved(b"other" * 5, "t", x, n) for x in range(n)]


def values(kind, n=300):
    draw = random.Random(kind)
    digits = lambda k: "".join(draw.choice("0123456789") for _ in range(k))
    make = {
        "email": lambda: f"{draw.choice('abc')}{digits(2)}.x@mail{digits(1)}.example.com",
        "card": lambda: draw.choice("456") + digits(15),
        "ssn": lambda: f"{draw.randint(100, 999)}-{draw.randint(10, 99)}-{digits(4)}",
        "phone": lambda: f"+1 ({digits(3)}) 555-{digits(4)}",
        "ip": lambda: f"10.{draw.randint(0, 255)}.0.{draw.randint(0, 255)}",
        "person": lambda: f"{draw.choice(list(s.FIRST))} {draw.choice(['Smith', 'Miller', 'Müller', 'Lopez'])}",
    }[kind]
    return sorted({make() for _ in range(n)})


@pytest.mark.parametrize("kind", ["email", "card", "ssn", "phone", "ip", "person"])
def test_distinct_stay_distinct_and_keep_kind_and_format(kind):
    old = values(kind)
    new = [s.surrogate(KEY, kind, v) for v in old]
    assert len(set(new)) == len(old) and all(a != b for a, b in zip(old, new, strict=True))
    for a, b in zip(old, new, strict=True):
        found = s.detect(f"x {b} y")
        assert [k for _, _, k in found] == [kind], (a, b)
        if kind == "card":
            assert s.luhn(a) == s.luhn(b) and len(a) == len(b)
        elif kind == "ip":
            assert s.network_of(a) == s.network_of(b)
        elif kind == "person":
            assert s.FIRST[a.split()[0]] == s.FIRST[b.split()[0]] and b.split()[1] not in s.FIRST
        else:
            assert [c if not c.isalnum() else c.isdigit() for c in a] == [c if not c.isalnum() else c.isdigit() for c in b]


def test_coreference_over_formats_and_case():
    plain, spaced = s.surrogate(KEY, "card", "4111111111111111"), s.surrogate(KEY, "card", "4111 1111 1111 1111")
    assert plain == spaced.replace(" ", "") and s.luhn(plain)
    assert s.surrogate(KEY, "email", "Ann.Lee@Mail.example.com").lower() == s.surrogate(KEY, "email", "ann.lee@mail.example.com")
    alone, full = s.surrogate(KEY, "person", "Schmidt"), s.surrogate(KEY, "person", "Maria Schmidt")
    assert full.split()[1] == alone
    assert s.surrogate(KEY, "person", "Анна Петрова").endswith("ова")
    iban = s.surrogate(KEY, "iban", "DE89370400440532013000")
    assert iban.startswith("DE") and s.iban_valid(iban)


def test_detection():
    text = "Mr. Peter Novak (p.novak@x-y.co.uk) +1 (499) 555-6503, 10.0.0.1, 123-45-6789, 4785380592391139&&& Sincerely Yours, version 4.0."
    assert [(k, text[a:b]) for a, b, k in s.detect(text)] == [
        ("person", "Peter Novak"), ("email", "p.novak@x-y.co.uk"), ("phone", "+1 (499) 555-6503"), ("ip", "10.0.0.1"), ("ssn", "123-45-6789"), ("card", "4785380592391139"),
    ]
    assert s.detect("Nothing here but 12 words, 3.14 and 2024-01-30.") == []


def test_card_numbers_may_begin_with_zero():
    for value in ("0007687199101951", "0000000000000000", "0810992847249404", "0810 9928 4724 9404", "4785380592391139"):
        new, entities = s.replace(f"Card {value}, thanks", lambda k, v: s.surrogate(KEY, k, v))
        assert [e[0] for e in entities] == ["card"] and value not in new
        assert re.fullmatch(r"Card [0-9](?: ?[0-9]){15}, thanks", new) and s.luhn(re.sub(r"\D", "", new)) == s.luhn(value.replace(" ", ""))


def test_planted_forms_are_gone_by_patterns_of_their_own(spark):
    planted = [r"(?<![0-9A-Za-z.])[0-9]{16}(?![0-9A-Za-z])", r"\+1 \([0-9]{3}\) 555-[0-9]{4}", r"[a-z0-9.]+@[a-z0-9.]+\.[a-z]{2,}", r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"]
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect() if r.text]
    seen = 0
    for text in texts:
        values = {v for p in planted for v in re.findall(p, text)}
        if values:
            new = s.replace(text, lambda k, v: s.surrogate(KEY, k, v))[0]
            assert not [v for v in values if v in new]
            seen += len(values)
    assert seen > 300


def test_short_mentions_of_detected_persons_are_replaced_alike():
    make = lambda k, v: s.surrogate(KEY, k, v)
    new, entities = s.replace("Maria Schmidt called. Schmidt's car, SCHMIDT! Maria left; Mariana and Schmidtke, schmidt@Schmidt.de stay.", make)
    first, last = make("person", "Maria"), make("person", "Schmidt")
    assert new.startswith(f"{first} {last} called. {last}'s car, {last.upper()}! {first} left; Mariana and Schmidtke, ") and new.endswith(" stay.")
    assert [e[0] for e in entities] == ["person"] * 4 + ["email"]
    assert "Novak" not in s.replace("Novak won. Dr. Novak-Weiss thanked Novak, Weiss thanked no one.", make)[0]
    assert s.replace("Анна Петрова пришла. Петрова ушла.", make)[0].count(make("person", "Петрова")) == 2
    assert s.replace("Anna The end. The day of Schmidt.", make)[0].endswith(" end. The day of Schmidt.")
    assert s.replace("Schmidt said no.", make)[0] == "Schmidt said no."


def test_national_phone_numbers():
    for value in ("06 12 34 56 78", "06.12.34.56.78", "06-12-34-56-78", "030 1234567", "030/1234567", "(030) 1234567", "0171-12345678", "030 12 34 56 78"):
        new, entities = s.replace(f"Tel. {value}, bis 12 Uhr", lambda k, v: s.surrogate(KEY, k, v))
        assert [(e[0], e[3]) for e in entities] == [("phone", value)] and value not in new
        assert [c if not c.isalnum() else c.isdigit() for c in entities[0][4]] == [c if not c.isalnum() else c.isdigit() for c in value]
        assert [k for _, _, k in s.detect(f"x {entities[0][4]} y")] == ["phone"]
    assert s.surrogate(KEY, "phone", "030 1234567") == s.surrogate(KEY, "phone", "030/1234567").replace("/", " ")
    assert s.detect("On 01.02.2024, 08:30, 0.12345678 and 100 200000 of 0 1234567.") == []


def test_rows(spark):
    long = "x " * 50000 + "ann@example.com"
    rows = [(1, None, "a"), (2, "", "a"), (3, "ann@example.com 10.0.0.1", "a"), (3, "ann@example.com 10.0.0.1", "a"), (None, long, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, entities string")
    got = s.pseudonymise(df, "key", ["doc_id"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text is None and by[2][0].text == "" and not by[1][0].entities
    assert by[3][0] == by[3][1] and [e.kind for e in by[3][0].entities] == ["email", "ip"]
    mail = by[3][0].text.split()[0]
    assert by[None][0].text == "x " * 50000 + mail and "ann@example" not in by[3][0].text
    assert s.pseudonymise(df.limit(0), "key", ["doc_id"]).count() == 0
    pairs = spark.createDataFrame([("ip", "a", "x"), ("ip", "b", "x"), ("ip", "A", "y"), ("ip", "a", "y"), ("card", "c", "x")], "kind string, value string, surrogate string")
    assert [tuple(r) for r in s.collisions(pairs).collect()] == [("ip", "x")]


def test_query_leaves_no_entity_and_no_collision(spark):
    from newslens.llm.queries import QUERIES

    old = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    pairs = set()
    for r in QUERIES["op5_surrogates"](spark, "/root/testdata/sf0.01").collect():
        spans = [(k, int(a), int(b)) for k, a, b in (e.split(":") for e in r.entities.split(",") if e)]
        assert len(spans) == r.n_entities
        for kind, a, b in spans:
            value = old[r.doc_id][a:b]
            assert value not in r.text
            pairs.add((kind, value.lower()))
        if not spans:
            assert r.text == old[r.doc_id]
    assert len(pairs) > 20
