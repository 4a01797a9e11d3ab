"""PII: personal data replaced by keyed surrogates of the same kind and format.

Every surrogate comes from a keyed permutation of all values of one kind and format, built
from a Feistel network over their number. A permutation cannot send two values to one, so
distinct entities stay distinct without knowing each other, and one entity has the same
surrogate wherever it occurs. Checks on a surrogate (a valid check digit, the same class of
address, no name that has a list of its own) are met by walking the permutation until they
hold, which keeps it one. It is made of a permutation P and a shift as
inverse(P)((P(x) + c) mod n), which moves every value: nothing is replaced by itself.

Letters go to letters of their script, vowels to vowels, digits to digits; case, signs,
titles and lengths stay. Known first names go to first names of the same gender and script.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from bisect import bisect_right
from collections.abc import Callable
from functools import lru_cache
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import map_texts

KINDS = ("email", "iban", "card", "ssn", "ip", "phone", "person")
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
CARD = re.compile(r"(?<![0-9A-Za-z.])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z])")
SSN = re.compile(r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])")
PHONE = re.compile(r"(?<![\w.+])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-][0-9]{3,4}(?![0-9A-Za-z])")
PHONE_PLAIN = re.compile(r"(?<![\w.+])\+[0-9]{1,3}(?:[ .\-]?[0-9]){8,12}(?![0-9A-Za-z])")
#: National forms: groups of two digits, and one long group after the prefix.
PHONE_PREFIX = r"(?<![\w.+])(?:\(0[0-9]{1,4}\) ?|0[0-9]{1,4}[ .\-/])"
PHONE_PAIRS = re.compile(rf"{PHONE_PREFIX}[0-9]{{2}}(?:[ .\-][0-9]{{2}}){{2,4}}(?![0-9A-Za-z])")
PHONE_LONG = re.compile(rf"{PHONE_PREFIX.replace(' .', ' ')}[0-9]{{5,8}}(?![0-9A-Za-z])")
IP = re.compile(rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])")
#: First names by gender and script.
NAMES = {
    ("f", "latin"): "Alice Amelia Andrea Anna Barbara Carmen Caroline Charlotte Claudia Elena Elizabeth Emily Emma Eva Hannah Helen Isabel Jane Jessica Julia Karen Laura Lisa Lucia Maria Marie Mary Nicole Olivia Patricia Paula Rosa Sarah Sofia Sophie Susan Teresa Ursula Victoria".split(),
    ("m", "latin"): "Alexander Andrew Antonio Carlos Charles Christian Daniel David Diego Edward Francisco Frank George Hans Henry Jack James Javier Jean Johann John Joseph Juan Klaus Lucas Luis Manuel Mark Martin Michael Miguel Pablo Paul Pedro Peter Philippe Pierre Richard Robert Stefan Thomas William".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Екатерина Елена Ирина Ксения Людмила Марина Мария Надежда Наталья Ольга Полина Светлана София Татьяна".split(),
    ("m", "cyrillic"): "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Евгений Иван Игорь Константин Максим Михаил Николай Олег Павел Пётр Сергей".split(),
}
FIRST = {name: group for group, names in NAMES.items() for name in names}
TITLES = r"Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Herr|Frau|Señora|Señor|Sra|Sr|Don|Doña|Monsieur|Madame|Mme|Mlle|Mr\.|г-н|г-жа"
WORD = r"(?:[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+|[А-ЯЁ][а-яё]+)"
PERSON = re.compile(rf"(?<!\w)(?:(?:{TITLES})\.? +((?:{WORD}[ \-]){{0,2}}{WORD})|((?:{'|'.join(sorted(FIRST))})(?:[ \-]{WORD}){{1,2}}))(?!\w)")
#: A word that may be a short mention of a person, and words that never are, though a title or first name may stand before them.
MENTION = re.compile(rf"(?<!\w)(?:{WORD}|[A-ZÀ-ÖØ-Þ]{{2,}}|[А-ЯЁ]{{2,}})(?!\w)")
FUNCTION_WORDS = frozenset("The This That These Those He She It We You They His Her Its Our Your Their And Or But If In On At By For From Of To With As Is Was Are Not No Der Die Das Ein Eine Und Er Sie Es Wir Ihr Im Am Le La Les Un Une Et Il Elle Nous Vous Ils El Los Las Una Uno Y En De Du Des Del Él Ella И Он Она Они Мы Вы В Не Но На С По".split())
#: Letters that stand in for one another.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "ñçß", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ")
CLASS_OF = {c: k for k, letters in enumerate(CLASSES) for c in letters}
FEMININE = ("ова", "ева", "ина", "ская")
ROUNDS = 6


def _draw(key: bytes, tweak: str, number: int, value: int, below: int) -> int:
    text = f"{tweak}\0{number}\0{value}".encode()
    return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=max(16, below.bit_length() // 8 + 9)).digest(), "big") % below


def _turn(key: bytes, tweak: str, x: int, n: int, back: bool) -> int:
    """A keyed permutation of 0..n-1, or its inverse: Feistel rounds over a grid of at least n cells."""
    wide = math.isqrt(n - 1) + 1
    tall = -(-n // wide)
    while True:
        left, right = divmod(x, tall)
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if r % 2:
                right = (right + sign * _draw(key, tweak, r, left, tall)) % tall
            else:
                left = (left + sign * _draw(key, tweak, r, right, wide)) % wide
        x = left * tall + right
        if x < n:
            return x


def moved(key: bytes, tweak: str, x: int, n: int) -> int:
    """A keyed permutation of 0..n-1 that leaves nothing in place (for n over 1)."""
    if n < 2:
        return x
    shift = 1 + _draw(key, tweak, -1, 0, n - 1)
    return _turn(key, tweak, (_turn(key, tweak, x, n, False) + shift) % n, n, True)


def walked(step: Callable[[str], str], value: str, good: Callable[[str], bool]) -> str:
    """The next value of the permutation after ``value`` that is good, as ``value`` itself must be."""
    found = step(value)
    while not good(found):
        found = step(found)
    return found


def letters(key: bytes, kind: str, value: str, fixed: Callable[[int], bool] = lambda i: False) -> str:
    """Letters and digits replaced by others of their class; case, other signs and ``fixed`` places stay.
    Values that differ only in case get surrogates that do, too."""
    low = [c.lower() if len(c.lower()) == 1 else c for c in value]
    first_digit = lambda i: low[i].isdigit() and (i == 0 or low[i - 1] not in CLASSES[0])
    # a leading zero stays one, and no other digit becomes one
    places = [i for i, c in enumerate(low) if c in CLASS_OF and not fixed(i) and not (c == "0" and first_digit(i))]
    lead, chosen = {i for i in places if first_digit(i)}, set(places)
    shape = "".join("abcdefg"[CLASS_OF[c]] if i in chosen else c for i, c in enumerate(low)) + "".join(f",{i}" for i in sorted(lead))
    x, n = 0, 1
    for i in places:
        own = CLASSES[CLASS_OF[low[i]]][1 if i in lead else 0 :]
        x, n = x * len(own) + own.index(low[i]), n * len(own)
    x = moved(key, f"{kind}\0{shape}", x, n)
    out = list(value)
    for i in reversed(places):
        own = CLASSES[CLASS_OF[low[i]]][1 if i in lead else 0 :]
        x, at = divmod(x, len(own))
        out[i] = own[at].upper() if value[i] != low[i] else own[at]
    return "".join(out)


def bare(key: bytes, kind: str, value: str, begin: int = 0, fixed: int = 0) -> str:
    """``letters`` of the value without its separators from ``begin`` on, which are then put back,
    so that one number has one surrogate however it is grouped."""
    plain = [c for c in value[begin:] if c.isalnum()]
    made = iter(letters(key, kind, "".join(plain), lambda i: i < fixed))
    return value[:begin] + "".join(next(made) if c.isalnum() else c for c in value[begin:])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


#: Ranges with a meaning of their own; addresses stay inside theirs.
NETWORKS = tuple(ipaddress.IPv4Network(n) for n in ("0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16", "224.0.0.0/4", "240.0.0.0/4"))


def network_of(value: str) -> ipaddress.IPv4Network | None:
    ip = ipaddress.IPv4Address(value)
    return next((n for n in NETWORKS if ip in n), None)


def _ip(key: bytes, value: str) -> str:
    if own := network_of(value):
        first = int(own.network_address)
        return str(ipaddress.IPv4Address(first + moved(key, f"ip\0{own}", int(ipaddress.IPv4Address(value)) - first, own.num_addresses)))
    step = lambda v: str(ipaddress.IPv4Address(moved(key, "ip", int(ipaddress.IPv4Address(v)), 1 << 32)))
    return walked(step, value, lambda v: network_of(v) is None)


def _name(key: bytes, word: str) -> str:
    """A first name of the list's gender and script, or letters for letters, but no name of a list.
    A word in capitals gets the surrogate of the usual form, in capitals."""
    if len(word) > 1 and word.isupper():
        return _name(key, word.capitalize()).upper()
    if word in FIRST:
        names = NAMES[FIRST[word]]
        return names[moved(key, f"first\0{FIRST[word]}", names.index(word), len(names))]
    tail = next((len(t) for t in FEMININE if word.endswith(t) and len(word) > len(t) + 2), 0)
    return walked(lambda w: letters(key, "name", w, lambda i: i >= len(word) - tail), word, lambda w: w not in FIRST)


def surrogate(key: bytes, kind: str, value: str) -> str:
    """The replacement of a detected value."""
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        return letters(key, "email", local) + "@" + ".".join([*[letters(key, "domain", d) for d in labels[:-1]], labels[-1]])
    if kind == "card":
        valid = luhn(re.sub(r"\D", "", value))
        return walked(lambda v: bare(key, "card", v), value, lambda v: luhn(re.sub(r"\D", "", v)) == valid)
    if kind == "iban":
        valid = iban_valid(value)
        return walked(lambda v: bare(key, "iban", v, fixed=2), value, lambda v: iban_valid(v) == valid)
    if kind == "phone":
        country = re.match(r"\+[0-9]{1,3}(?=[ .\-(])", value)
        return bare(key, "phone", value, country.end() if country else 0)
    if kind == "ssn":
        return bare(key, "ssn", value)
    if kind == "ip":
        return _ip(key, value)
    if kind == "person":
        return re.sub(r"[^ \-]+", lambda m: _name(key, m[0]), value)
    return letters(key, kind, value)


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, in order and apart; of overlapping finds the kind listed first stays.
    Words of the persons' names are found wherever else the text has them, too."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        for kind, pattern in (("iban", IBAN), ("card", CARD), ("ssn", SSN), ("phone", PHONE), ("phone", PHONE_PLAIN), ("phone", PHONE_PAIRS), ("phone", PHONE_LONG), ("ip", IP)):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    for m in PERSON.finditer(text):
        at = 1 if m[1] else 2
        found.append((m.start(at), m.end(at), "person"))
    found.sort(key=lambda s: (KINDS.index(s[2]), s[0]))
    kept: list[tuple[int, int, str]] = []
    for _, some in groupby(found, key=lambda s: s[2]):
        starts, new = [a for a, _, _ in kept], []
        for a, b, kind in some:
            at = bisect_right(starts, a)  # kept spans are apart: only the neighbours can overlap
            if (not at or kept[at - 1][1] <= a) and (at == len(kept) or b <= starts[at]) and (not new or new[-1][1] <= a):
                new.append((a, b, kind))
        kept = sorted(kept + new)
    return sorted(kept + mentions(text, kept))


def mentions(text: str, kept: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Words of the names in ``kept``, as they are or in capitals, where they stand outside of its spans."""
    parts = {w for a, b, kind in kept if kind == "person" for w in re.split(r"[ \-]", text[a:b])} - FUNCTION_WORDS
    parts |= {w.upper() for w in parts}
    if not parts:
        return []
    found, at = [], 0
    for m in MENTION.finditer(text):
        while at < len(kept) and kept[at][1] <= m.start():
            at += 1
        if m[0] in parts and (at == len(kept) or m.end() <= kept[at][0]):
            found.append((m.start(), m.end(), "person"))
    return found


DIGIT = re.compile(r"[0-9]{2}|[0-9]\.")


def replace(text: str | None, make: Callable[[str, str], str]) -> tuple[str | None, list[tuple[str, int, int, str, str]]]:
    """The text with surrogates, and (kind, start, end, value, surrogate) of each entity, places in the old text."""
    if not text:
        return text, []
    parts, at, entities = [], 0, []
    for a, b, kind in detect(text):
        new = make(kind, text[a:b])
        parts += [text[at:a], new]
        entities.append((kind, a, b, text[a:b], new))
        at = b
    return "".join([*parts, text[at:]]) if entities else text, entities


def pseudonymise(df: DataFrame, key: str, columns: list[str], text: str = "text", into: str = "entities") -> DataFrame:
    """``columns`` of ``df`` with the text, its entities replaced, and as column ``into`` the entities (kind, start,
    end in code points of the old text, surrogate).

    Null stays null and has no entities, like the empty text. Time grows with a text's length,
    whether it is one unbroken run or full of entities. Rows are independent: copies get the same surrogates. No rows give no rows. Keep ``key`` secret and the same
    wherever surrogates must agree.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def make():
        known = lru_cache(1 << 17)(lambda kind, value: surrogate(secret, kind, value))

        def work(*values):
            done = [replace(t, known) for t in values[-1]]
            return [*values[:-1], [t for t, _ in done], [[{"kind": k, "start": a, "end": b, "surrogate": s} for k, a, b, _, s in e] for _, e in done]]

        return work

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)
    return map_texts(df, [*columns, text], kinds + f"`{text}` string, `{into}` array<struct<kind:string,start:int,end:int,surrogate:string>>", make)


def collisions(pairs: DataFrame) -> DataFrame:
    """kind and surrogate given to more than one value, of a table (kind, value, surrogate); none, if all is well."""
    apart = pairs.groupBy("kind", "surrogate").agg(F.min(F.lower("value")).alias("a"), F.max(F.lower("value")).alias("b"))
    return apart.filter("a <> b").select("kind", "surrogate")
