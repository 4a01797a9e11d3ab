"""Line-first quality rules in DataFrame expressions.

Each line with a word is judged by itself: by its punctuation (symbols, exclamation marks,
long runs without any stop), as navigation (separators, short lines of menu words) and as
boilerplate (licence and site phrases). Failing lines are removed; a document that loses
too much of its text with them is rejected, as is one that is too short or repeats itself.
All of it happens inside the row: nothing is exploded or shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
WORD_LETTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
MARKED = r"[#*$%&|<>!]"
STOPS = r"[.,;:!?]"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words inside repeated three-word windows
MAX_LOST = 30  # percent of the text's non-space characters lost with failing lines
SYMBOL_SHARE = 10  # percent of a line's non-space characters
WORDS_PER_MARK = 3  # a line has more than one exclamation mark in so many words
UNSTOPPED_WORDS = 30  # a line has so many words and no stop
SEPARATORS = 3  # bars in a line
MENU_WORDS = 8
MENU = r"(^|[^a-z])(home|menu|log ?in|sign ?up|sign ?in|next page|previous page|read more|share this|skip to content|site ?map|contact us)([^a-z]|$)"
BOILERPLATE = (
    "licensed under", "licenced under", "all rights reserved", "copyright", "spdx-license", "cookie policy", "privacy policy",
    "terms of use", "terms of service", "enable javascript", "javascript is disabled", "subscribe to our newsletter", "lorem ipsum",
)


def matches(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern)) - 1


def line_facts(line: Column) -> Column:
    """What the rules ask of a line; ``line`` has the fields s, low (lower case) and parts (cut at white space)."""
    return F.struct(
        line["s"].alias("s"),
        line["low"].alias("low"),
        F.size(F.array_remove(line["parts"], "")).alias("words"),
        F.length(F.array_join(line["parts"], "")).alias("solid"),
        *[F.when(line["s"].rlike(MARKED), matches(line["s"], p)).otherwise(0).alias(n) for n, p in (("symbols", SYMBOLS), ("bars", r"\|"), ("marks", "!"))],
        line["s"].rlike(STOPS).alias("stopped"),
    )


def line_fails(fact: Column) -> Column:
    """Whether a line with a word breaks one of the three kinds of rules."""
    punctuation = (
        (fact["symbols"] * 100 > fact["solid"] * SYMBOL_SHARE)
        | (fact["marks"] * WORDS_PER_MARK > fact["words"])
        | (~fact["stopped"] & (fact["words"] >= UNSTOPPED_WORDS))
    )
    navigation = (fact["bars"] >= SEPARATORS) | ((fact["words"] <= MENU_WORDS) & fact["low"].rlike(MENU))
    boilerplate = reduce(Column.__or__, [fact["low"].contains(phrase) for phrase in BOILERPLATE])
    return (fact["words"] > 0) & (punctuation | navigation | boilerplate)


def covered_words(starts: Column) -> Column:
    """Words inside three-word windows that start at the ascending ``starts``, each word once."""
    reach = lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3)))
    return F.aggregate(F.transform(starts, reach), F.lit(0), lambda total, n: total + n)


def apply_rules(df: DataFrame, text: str = "text", into: str = "_rules") -> DataFrame:
    """``df`` with the struct column ``into``: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, lost_chars, cleaned (the text without failing lines), base_failed, kept.

    A null text counts as empty; empty and wordless texts fail for want of words. Rows are
    judged one by one, so repeated rows get the same verdict; other columns pass through.
    Should the table have a column of that name already, it is replaced.
    """
    r = lambda name: F.col(f"{into}.{name}")
    # each step is used several times by the next one, which keeps Spark from folding it into a lambda
    body = F.coalesce(F.col(text), F.lit(""))
    cut = lambda line: F.struct(line.alias("s"), F.lower(line).alias("low"), F.split(line, GAP).alias("parts"))
    staged = df.withColumn(into, F.struct(F.transform(F.split(body, "\n"), cut).alias("lines"), F.lit(0).alias("_")))
    words = F.array_remove(F.flatten(F.transform(r("lines"), lambda line: line["parts"])), "")
    staged = staged.withColumn(into, F.struct(r("lines").alias("lines"), words.alias("words")))
    positions = F.when(F.size(r("words")) > 2, F.sequence(F.lit(0), F.size(r("words")) - 3)).otherwise(F.array().cast("array<int>"))
    three = lambda i: [F.get(r("words"), i + k) for k in range(3)]
    window = lambda i: F.struct(F.xxhash64(*three(i)).alias("hash"), i.alias("i"))
    staged = staged.withColumn(into, F.struct(
        r("words").alias("words"), F.transform(r("lines"), line_facts).alias("facts"),
        F.sort_array(F.transform(positions, window)).alias("windows"),
    ))
    # equal windows lie side by side, since their hashes are equal; the words decide
    equal = lambda x, y: reduce(Column.__and__, [a == b for a, b in zip(three(x["i"]), three(y["i"]), strict=True)], x["hash"] == y["hash"])
    beside = lambda x, j: F.coalesce(equal(x, F.get(r("windows"), j)), F.lit(False))
    twice = F.filter(r("windows"), lambda x, j: beside(x, j - 1) | beside(x, j + 1))
    verdict = lambda fact: F.struct(fact["s"].alias("s"), fact["solid"].alias("solid"), fact["symbols"].alias("symbols"), line_fails(fact).alias("fails"))
    staged = staged.withColumn(into, F.struct(
        F.size(r("words")).alias("n_words"), F.transform(r("facts"), verdict).alias("facts"),
        F.sort_array(F.transform(twice, lambda x: x["i"])).alias("starts"),
    ))
    total = lambda value: F.aggregate(r("facts"), F.lit(0).cast("bigint"), lambda n, fact: n + value(fact))
    full = F.transform(F.filter(r("facts"), lambda fact: fact["solid"] > 0), lambda fact: fact["s"])
    staged = staged.withColumn(into, F.struct(
        r("n_words").cast("bigint").alias("n_words"), total(lambda fact: fact["solid"]).alias("word_chars"),
        total(lambda fact: fact["symbols"]).alias("n_symbols"),
        (F.size(full) - F.size(F.array_distinct(full))).cast("bigint").alias("n_dup_lines"),
        covered_words(r("starts")).cast("bigint").alias("n_repeat_words"),
        total(lambda fact: F.when(fact["fails"], fact["solid"]).otherwise(0)).alias("lost_chars"),
        F.array_join(F.transform(F.filter(r("facts"), lambda fact: ~fact["fails"]), lambda fact: fact["s"]), "\n").alias("cleaned"),
    ))
    base_failed = (r("n_words") < MIN_WORDS) | (r("n_repeat_words") * 100 > r("n_words") * MAX_REPEATED)
    kept = ~base_failed & (r("lost_chars") * 100 <= r("word_chars") * MAX_LOST)
    # a filter on the verdict must not be pushed below here, where it would be worked out once for
    # itself and once for the result; Spark pushes none through a generator
    verdict = F.explode_outer(F.array(F.struct(f"{into}.*", base_failed.alias("base_failed"), kept.alias("kept"))))
    return staged.select(*[c for c in staged.columns if c != into], verdict.alias(into))
