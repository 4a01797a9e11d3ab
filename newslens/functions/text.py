"""Text expressions: article identity, model input, cleaning, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TITLE_CHARS = 200
BODY_CHARS = 100
CLEAN_CHARS = 2000
FEED_BODY_CHARS = 500
SEPARATOR = " [SEP] "
REAL_LABELS = ("true", "mostly-true", "half-true")
STOP_WORDS = (
    "le", "la", "les", "de", "du", "des", "un", "une", "et", "en", "à", "au", "aux",
    "est", "que", "qui", "pour", "par", "sur", "dans", "avec", "ce", "se", "il", "ils",
    "elle", "elles", "on", "nous", "vous", "the", "a", "an", "of", "in", "to", "and",
    "is", "it", "for", "that", "was", "are", "with", "as", "at", "by", "this", "from",
)
EDGE_PUNCTUATION = ".,;:!?\"'()[]{}"

# Unicode white space plus the ASCII separators 1C-1F, and word characters as letters,
# numbers and underscore; spelled out so that every regex engine agrees.
SPACE = r"\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"


def or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def content_id(url: Column, title: Column) -> Column:
    return F.md5(F.concat(or_empty(url), or_empty(title)))


def score_text(title: Column, body: Column) -> Column:
    """Classifier input."""
    return F.concat(
        F.substring(or_empty(title), 1, TITLE_CHARS), F.lit(SEPARATOR), F.substring(or_empty(body), 1, BODY_CHARS)
    )


def train_text(title: Column, body: Column) -> Column:
    """Online-training input: the title is not shortened here."""
    return F.concat(or_empty(title), F.lit(SEPARATOR), F.substring(or_empty(body), 1, BODY_CHARS))


def clean_text(column: Column) -> Column:
    steps = (
        (f"http[^{SPACE}]+", "[URL]"),
        (f"@[{WORD}]+", "[USER]"),
        ("&amp;", "&"),
        ("&lt;", "<"),
        ("&gt;", ">"),
        (f"[{SPACE}]+", " "),
    )
    text = or_empty(column)
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return F.substring(F.trim(text), 1, CLEAN_CHARS)


def liar_label(column: Column) -> Column:
    return F.when(F.trim(column).isin(*REAL_LABELS), 0).otherwise(1)


def tokens(column: Column) -> Column:
    """Lower-cased runs of letters and numbers."""
    return F.regexp_extract_all(F.lower(or_empty(column)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def counts(values: Column) -> Column:
    """Distinct elements of a non-empty array with their number, as structs (value, n).

    The array is sorted and read off as runs inside its own row, so counting the words of
    a document needs no shuffle. The one-element arrays make sure that each step is
    evaluated once.
    """

    def runs(ordered: Column) -> Column:
        differs = lambda i: F.element_at(ordered, i) != F.element_at(ordered, F.greatest(i - 1, F.lit(1)))
        starts = F.filter(F.sequence(F.lit(1), F.size(ordered)), lambda i: (i == 1) | differs(i))
        return F.flatten(F.transform(F.array(starts), lambda at: lengths(ordered, at)))

    def lengths(ordered: Column, starts: Column) -> Column:
        end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(ordered) + 1)
        return F.transform(
            starts, lambda at, k: F.struct(F.element_at(ordered, at).alias("value"), (end(k) - at).cast("long").alias("n"))
        )

    return F.flatten(F.transform(F.array(F.sort_array(values)), runs))


def words(column: Column) -> Column:
    """White-space separated words, stripped of edge punctuation and apostrophes."""
    pieces = F.split(F.lower(or_empty(column)), f"[{SPACE}]+")
    return F.transform(pieces, lambda w: F.replace(F.btrim(w, F.lit(EDGE_PUNCTUATION)), F.lit("'"), F.lit("")))
