"""BPE encoding and decoding in batched numpy merge rounds.

The distinct words of many texts lie as symbols in one flat array. Each round looks every
adjacent pair up by binary search in the sorted pair keys, finds the lowest rank of each
word, and merges all its occurrences at once; words without a known pair leave the array.
A pair that holds a merged symbol always ranks behind the merge that made the symbol, so
merging all occurrences of the lowest pair together equals merging them one by one.

Vocabularies are files of the ``tokenizers`` library with NFC, lower case, the word pattern
below and a word-end suffix. Their place is a parameter; they are read on the driver and
sent to the tasks as arrays whose size the vocabulary bounds.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from newslens.llm.common import map_texts

#: Fixed values of the file format: white space of its pattern engine, and its word pattern.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
END = "</w>"
SPACES = regex.compile(f"[{SPACE}]+")
SEPARATORS = regex.compile("[\\x1c-\\x1f]")
NONE = np.iinfo(np.int64).max
SPOT_BITS = 20
CACHE_WORDS = 800_000
CACHE_SYMBOLS = 8_000_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def spot(pairs: np.ndarray) -> np.ndarray:
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SPOT_BITS)


@dataclass(frozen=True)
class Vocabulary:
    tokens: tuple[str, ...]
    special: dict[str, int]
    inner: np.ndarray  # id of each byte inside a word
    last: np.ndarray  # id of each byte at a word's end
    keys: np.ndarray  # sorted pair keys: left id * number of tokens + right id
    ranks: np.ndarray
    merged: np.ndarray
    occupied: np.ndarray  # whether any key falls on a spot: most unknown pairs need no search

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = dict(spec["model"]["vocab"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(*ids.values(), *special.values()) + 1
        tokens = [""] * size
        for token, number in [*ids.items(), *special.items()]:
            tokens[number] = token
        letters = byte_letters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        occupied = np.zeros(1 << SPOT_BITS, bool)
        occupied[spot(keys)] = True
        return cls(
            tuple(tokens), special,
            np.array([ids[x] for x in letters], np.int64), np.array([ids[x + END] for x in letters], np.int64),
            keys[order], order.astype(np.int64), merged[order], occupied,
        )

    def merge(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over a flat array of symbols; ``words`` numbers the word of each symbol,
        ascending. Returns the final symbols and their words, in order."""
        size, ready = len(self.tokens), []
        while len(symbols):
            rank, made = np.full(len(symbols), NONE), None
            if len(symbols) > 1:
                pair = symbols[:-1] * size + symbols[1:]
                maybe = np.flatnonzero(self.occupied[spot(pair)] & (words[:-1] == words[1:]))
                at = np.minimum(np.searchsorted(self.keys, pair[maybe]), len(self.keys) - 1)
                known = self.keys[at] == pair[maybe]
                maybe, at = maybe[known], at[known]
                rank[maybe] = self.ranks[at]
                made = np.zeros(len(pair), np.int64)
                made[maybe] = self.merged[at]
            starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            lengths = np.diff(np.r_[starts, len(symbols)])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            over = lowest == NONE
            if over.any():
                ready.append((words[over], symbols[over]))
                if over.all():
                    break
            chosen = (rank == lowest) & ~over
            # in a run of one repeated symbol, every second pair merges
            place = np.arange(len(symbols))
            first = np.maximum.accumulate(np.where(chosen & ~np.r_[False, chosen[:-1]], place, -1))
            chosen &= (place - first) % 2 == 0
            symbols = symbols.copy()
            symbols[chosen] = made[np.flatnonzero(chosen)]
            keep = ~over & ~np.r_[False, chosen[:-1]]
            symbols, words = symbols[keep], words[keep]
        if not ready:
            return symbols, words
        words, symbols = (np.concatenate(x) for x in zip(*ready, strict=True))
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]


def grown(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` after its first ``used`` values, in twice the room where it was full."""
    if used + len(more) > len(held):
        held = np.concatenate([held[:used], np.zeros(used + 2 * len(more), held.dtype)])
    held[used : used + len(more)] = more
    return held


class Coder:
    """Encodes and decodes lists of texts; keeps the ids of words it has met, up to a bound. Beyond
    it the words stay that were met most often."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.id_text = [str(i) for i in range(len(vocabulary.tokens))]
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str | tuple[str], int] = {}
        self.flat, self.starts, self.lengths = (np.zeros(1 << 12, np.int32) for _ in range(3))
        self.used = self.words_held = 0
        self.met = np.zeros(0, np.int64)  # how often each word held was met
        for token, value in self.vocabulary.special.items():
            self.number[(token,)] = len(self.number)
        values = np.array(list(self.vocabulary.special.values()), np.int64)
        self._append(values, np.ones(len(values), np.int64))

    def _forget(self) -> None:
        """Keep the words met most often, specials always, to half the bounds."""
        met, held = self.met, np.arange(self.words_held)
        least = 1
        fixed = held < len(self.vocabulary.special)
        while True:
            kept = fixed | (met > least)
            if kept.sum() <= CACHE_WORDS // 2 + fixed.sum() and self.lengths[: self.words_held][kept].sum() <= CACHE_SYMBOLS // 2 + fixed.sum():
                break
            least *= 2
        place = np.cumsum(kept) - 1
        self.number = {w: int(place[i]) for w, i in self.number.items() if kept[i]}
        starts, lengths = self.starts[: self.words_held][kept], self.lengths[: self.words_held][kept]
        ends = np.cumsum(lengths, dtype=np.int64)
        flat = self.flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])] if len(ends) else self.flat[:0]
        self.flat, self.starts, self.lengths = flat, (ends - lengths).astype(np.int32), lengths
        self.used, self.words_held, self.met = len(flat), int(kept.sum()), met[kept] // 2

    def _append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = grown(self.starts, self.words_held, self.used + np.cumsum(lengths) - lengths)
        self.lengths = grown(self.lengths, self.words_held, lengths)
        self.flat = grown(self.flat, self.used, flat)
        self.words_held += len(lengths)
        self.used += len(flat)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # the library lowers letter by letter, without the final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # str.split also cuts at the four separators 1C-1F, which are letters of a word here
        return SPACES.split(text) if SEPARATORS.search(text) else text.split()

    def words(self, text: str) -> list:
        """The stretches between white space; no word crosses one, and most come again and again.
        Special tokens, found in the raw text, are one-tuples."""
        if self.split_special is None or not any(t in text for t in self.vocabulary.special):
            return self._plain(text)
        found: list = []
        for i, part in enumerate(self.split_special.split(text)):
            found.extend([(part,)] if i % 2 else self._plain(part))
        return found

    def _learn(self, stretches: set) -> None:
        new = list(stretches)
        words = [WORD.findall(x) for x in new]
        # the words of the stretches, each once
        place: dict[str, int] = {}
        every = [place.setdefault(w, len(place)) for x in words for w in x]
        raw = [w.encode("utf-8") for w in place]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        octets = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.vocabulary.inner[octets]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.vocabulary.last[octets[ends]]
        ids, owner = self.vocabulary.merge(symbols, np.repeat(np.arange(len(raw)), lengths))
        counts = np.bincount(owner, minlength=len(raw))
        begins = np.cumsum(counts) - counts
        at = np.array(every, np.int64)
        lengths = counts[at]
        ends = np.cumsum(lengths)
        ids = ids[np.repeat(begins[at] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        stretch = np.repeat(np.arange(len(new)), [len(x) for x in words])
        known = self.words_held
        self._append(ids, np.bincount(stretch, lengths, len(new)).astype(np.int64))
        self.number.update(zip(new, range(known, known + len(new)), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one flat array, and the number of ids of each; null counts as empty."""
        if len(self.number) > CACHE_WORDS or self.used > CACHE_SYMBOLS:
            self._forget()
        words = [self.words(t) if t else [] for t in texts]
        every: list = []
        for x in words:
            every.extend(x)
        at = np.fromiter(map(self.number.get, every, repeat(-1)), np.int32, len(every))
        if len(missing := np.flatnonzero(at < 0).tolist()):
            self._learn({every[i] for i in missing})
            at[missing] = [self.number[every[i]] for i in missing]
        met = np.bincount(at, minlength=self.words_held)
        met[: len(self.met)] += self.met
        self.met = met
        lengths = self.lengths[at]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[np.repeat(self.starts[at] - (ends - lengths).astype(np.int32), lengths) + np.arange(total, dtype=np.int32)] if total else np.zeros(0, np.int32)
        upto = np.cumsum([0, *map(len, words)])
        bounds = np.r_[0, ends][upto]
        return flat, np.diff(bounds)

    def decode(self, ids: list[int]) -> str:
        """The tokens, specials included, joined by a space: the vocabulary names no decoder."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in ids])


_coders: dict[int, Coder] = {}


def coder_of(shared: Broadcast) -> Coder:
    """The coder of a broadcast vocabulary, kept by the Python worker from task to task."""
    if id(shared.value) not in _coders:
        _coders.clear()
        _coders[id(shared.value)] = Coder(shared.value)
    return _coders[id(shared.value)]


def encode_decode(df: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, the ids of the whole text and the text decoded from them.

    Null and empty texts have no ids and decode to the empty text. Rows are independent:
    repeated rows give repeated results, other columns are left out.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        coder = coder_of(shared)

        def work(keys, texts):
            flat, counts = coder.encode(texts)
            ids = np.split(flat, np.cumsum(counts)[:-1])
            return [keys, [x.tolist() for x in ids], [coder.decode(x.tolist()) for x in ids]]

        return work

    kind = df.schema[doc_id].dataType.simpleString()
    return map_texts(df, [doc_id, text], f"doc_id {kind}, ids array<int>, decoded string", make)


def code_digests(df: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode_decode`` with the digests taken in the same task, so that ids need not leave it."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        coder = coder_of(shared)
        names = coder.id_text

        def work(keys, texts):
            flat, counts = coder.encode(texts)
            listed, at, shas, decoded = flat.tolist(), 0, [], []
            for n in counts.tolist():
                ids = listed[at : at + n]
                at += n
                shas.append(hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            return [keys, counts, shas, decoded]

        return work

    kind = df.schema[doc_id].dataType.simpleString()
    return map_texts(df, [doc_id, text], f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
