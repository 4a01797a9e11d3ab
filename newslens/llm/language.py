"""Language identification by prediction by partial matching.

For each language, byte counts in contexts of 0 to ``ORDER`` bytes are taken from a bounded
sample and frozen. A byte costs -log2 of its share in the longest known context; a context
in which it was not seen charges an escape (method C: as many escapes as different bytes)
and hands over to the next shorter one, down to one of 256. The language under which the
whole text has the shortest code is predicted.

Costs are laid out as sorted tables of byte strings, one row per string seen in any
language and one column per language, so that a batch of texts is scored by array lookups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import map_texts, unused

ORDER = 3
START = b"\n" * ORDER
DOCS_PER_LANGUAGE = 300
SLOT_BITS = 20
#: Bytes that are looked up at once.
STRETCH = 1 << 18
UNDETERMINED = "und"


@dataclass(frozen=True)
class Table:
    """Sorted keys, a row of values for each, and a hashed first guess of a key's place."""

    keys: np.ndarray
    values: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        slots = np.zeros(1 << SLOT_BITS, np.int32)
        slots[_slot(keys)] = np.arange(len(keys))
        return cls(keys, values, slots)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the wanted keys, and whether they are there."""
        if not len(self.keys):
            return np.zeros(len(wanted), np.int32), np.zeros(len(wanted), bool)
        at = self.slots[_slot(wanted)]
        there = self.keys[at] == wanted
        rest = np.flatnonzero(~there)
        if len(rest):
            place = np.minimum(np.searchsorted(self.keys, wanted[rest]), len(self.keys) - 1)
            at[rest] = place
            there[rest] = self.keys[place] == wanted[rest]
        return at, there


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint32(2654435761)) >> np.uint32(32 - SLOT_BITS)


def grams(octets: np.ndarray, order: int) -> np.ndarray:
    """At each byte, the number made of it and the ``order`` bytes before; wraps at the front."""
    made = octets.astype(np.uint32)
    for back in range(1, order + 1):
        made |= np.roll(octets, back).astype(np.uint32) << np.uint32(8 * back)
    return made


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    costs: tuple[Table, ...]  # by order: context and byte -> bits under each language
    escapes: tuple[Table, ...]  # by order: context -> bits of an escape, 0 where it is unknown

    def cost(self, order: int, wanted: np.ndarray) -> np.ndarray:
        if order < 0:
            return np.full((len(wanted), len(self.languages)), 8, np.float32)
        table = self.costs[order]
        at, there = table.find(wanted)
        out = table.values[at] if len(table.keys) else np.zeros((len(wanted), len(self.languages)), np.float32)
        rest = np.flatnonzero(~there)
        if len(rest):
            out[rest] = self.escape(order, wanted[rest] >> np.uint32(8)) + self.cost(order - 1, wanted[rest] & np.uint32((1 << 8 * order) - 1))
        return out

    def escape(self, order: int, contexts: np.ndarray) -> np.ndarray:
        table = self.escapes[order]
        at, there = table.find(contexts)
        return np.where(there[:, None], table.values[at], np.float32(0)) if len(table.keys) else np.zeros((len(contexts), len(self.languages)), np.float32)

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        raw = [START + t.encode("utf-8") for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        octets = np.frombuffer(b"".join(raw), np.uint8)
        begins = np.cumsum(sizes) - sizes
        counted = np.ones(len(octets), bool)
        for lead in range(ORDER):
            counted[begins + lead] = False
        found = grams(octets, ORDER)[counted]
        ends = np.cumsum(sizes - ORDER)
        starts = ends - (sizes - ORDER)
        total = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(found), STRETCH):
            upto = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(self.cost(ORDER, found[at : at + STRETCH]), axis=0, dtype=np.float64)])
            some = slice(np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + STRETCH))
            total[some] += upto[np.minimum(ends[some] - at, len(upto) - 1)] - upto[np.maximum(starts[some] - at, 0)]
        return total


def fit(samples: dict[str, list[str]]) -> Model:
    """The frozen statistics of sample texts by language."""
    if not samples:
        return Model((), (), ())
    languages = tuple(sorted(samples))
    flat = {}
    for name in languages:
        raw = [START + t.encode("utf-8") for t in samples[name]]
        octets = np.frombuffer(b"".join(raw), np.uint8)
        counted = np.ones(len(octets), bool)
        begins = np.cumsum([0, *map(len, raw)])[:-1]
        for lead in range(ORDER):
            counted[begins + lead] = False
        flat[name] = (octets, counted)
    model = Model(languages, (), ())
    for order in range(ORDER + 1):
        seen = {}
        for name, (octets, counted) in flat.items():
            keys, counts = np.unique(grams(octets, order)[counted], return_counts=True)
            contexts, first, different = np.unique(keys >> np.uint32(8), return_index=True, return_counts=True)
            totals = np.add.reduceat(counts, first) if len(first) else counts
            seen[name] = keys, counts, contexts, totals, different
        contexts = np.unique(np.concatenate([s[2] for s in seen.values()]))
        keys = np.unique(np.concatenate([s[0] for s in seen.values()]))
        escapes = np.zeros((len(contexts), len(languages)), np.float32)
        for column, name in enumerate(languages):
            _, _, own, totals, different = seen[name]
            escapes[np.searchsorted(contexts, own), column] = np.log2((totals + different) / different)
        shorter = model.cost(order - 1, keys & np.uint32((1 << 8 * order) - 1))
        costs = escapes[np.searchsorted(contexts, keys >> np.uint32(8))] + shorter
        for column, name in enumerate(languages):
            own_keys, counts, own, totals, different = seen[name]
            at = np.searchsorted(own, own_keys >> np.uint32(8))
            costs[np.searchsorted(keys, own_keys), column] = np.log2((totals[at] + different[at]) / counts)
        model = Model(languages, (*model.costs, Table.of(keys, costs.astype(np.float32))), (*model.escapes, Table.of(contexts, escapes)))
    return model


def sample(docs: DataFrame, train, docs_per_language: int = DOCS_PER_LANGUAGE) -> dict[str, list[str]]:
    """About ``docs_per_language`` texts of each language (all, if it has fewer), on the driver.

    The share to take follows from the counts by language; rows are chosen by a hash of their
    id, so that the choice is the same on every run. At most twice the number is collected.
    """
    usable = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, docs_per_language / n))])
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = (
        usable.filter(spot < F.element_at(share, F.col("lang"))).select("lang", "text", "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * docs_per_language * len(counts)).collect()
    )
    found: dict[str, list[str]] = {}
    for r in rows:
        found.setdefault(r["lang"], []).append(r["text"])
    return found


def predict(df: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of ``df`` with lang_pred, score (the language's share of probability under
    equal priors) and bits (its code length); these get underscores where ``columns`` has the name.

    Null texts and texts without a letter are ``und`` with score 0 and null bits; so is every
    text if no language was learned. Equal code lengths go to the first name in order. Rows are
    independent: repeated rows give repeated results, no rows give no rows. A text is worked
    through in stretches, so a very long one takes a few bytes a byte.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def work(*values):
            texts = values[-1]
            names, scores, bits = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
            able = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if known.languages else []
            if able:
                lengths = known.lengths([texts[i] for i in able])
                best = lengths.argmin(axis=1)
                least = lengths[np.arange(len(able)), best]
                share = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1)
                for i, b, s, n in zip(able, best.tolist(), share.tolist(), least.tolist(), strict=True):
                    names[i], scores[i], bits[i] = known.languages[b], s, n
            return [*values[:-1], names, scores, bits]

        return work

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)
    added = ", ".join(f"`{unused([*columns, text], name)}` {kind}" for name, kind in (("lang_pred", "string"), ("score", "double"), ("bits", "double")))
    return map_texts(df, [*columns, text], kinds + added, make)
