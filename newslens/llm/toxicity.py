"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of a general lexicon of insults and of words learned
from labelled texts, how near to a word of the second person they stand, shares of capitals
and of punctuation, and rates of obfuscated spelling. Trees of depth 3 are boosted on the
logistic loss over binned features; isotonic regression on out-of-fold margins turns their
sum into a probability. All of it is fitted on a bounded sample on the driver.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from newslens.llm.common import map_texts

SAMPLE = 8000
#: Insults of four languages, and words of the second person.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb dumbass loser losers scum trash garbage worthless pathetic clown clowns jerk pig filth filthy "
    "disgusting vermin freak creep bastard bitch asshole shit fuck fucking retard imbecile coward liar parasite fool hate kill "
    "idiote imbécile stupide crétin connard connasse salaud ordure pourriture minable débile merde abruti raclure pute "
    "idiota imbécil estúpido estúpida tonto basura escoria patético inútil mierda cabrón puta payaso asqueroso gilipollas "
    "dumm dummkopf trottel abschaum müll wertlos erbärmlich arschloch scheiße schwein versager dreckig hurensohn depp".split()
)
SECOND = frozenset("you your you're youre ur u yourself tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch sie tú ti tus usted ustedes vosotros".split())
NEAR = 5
PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~]+")
DISGUISED = re.compile(r"(?<![A-Za-z0-9])[@$0-9]?[A-Za-z]+[*@$0-9.\-_]+[A-Za-z][A-Za-z*@$0-9.\-_]*")
PLAIN = str.maketrans("@4301!$57", "aaeoiisst", "*.-_")
MIN_TOXIC = 4
MIN_WEIGHT = 1.5
NAMES = (
    "log_words", "lexicon_density", "lexicon_hits", "learned_density", "learned_hits", "learned_best", "learned_different",
    "near_second", "second_density", "capitals", "capital_words", "exclamations", "questions", "punctuation", "disguised", "disguised_hits", "stretched",
)
TREES = 60
DEPTH = 3
RATE = 0.15
BINS = 32
RIDGE = 2.0
FOLDS = 3


def words_of(text: str) -> list[str]:
    return PUNCTUATION.sub(" ", text.lower()).split()


def features(text: str | None, learned: dict[str, float]) -> list[float]:
    """The dense features of a whole text, in the order of ``NAMES``; all zero for an empty one."""
    text = text or ""
    words = words_of(text)
    n = len(words) or 1
    known = [(i, w) for i, w in enumerate(words) if w in INSULTS or w in learned]
    lexicon = sum(w in INSULTS for _, w in known)
    weights = {w: learned[w] for _, w in known if w in learned}
    weighed = sum(learned.get(w, 0.0) for _, w in known)
    second = [i for i, w in enumerate(words) if w in SECOND]
    near = 0
    if second and known:
        places, centres = np.array([i for i, _ in known]), np.array(second)
        near = int((np.searchsorted(centres, places + NEAR, "right") > np.searchsorted(centres, places - NEAR)).sum())
    octets = np.frombuffer(text.encode("utf-8"), np.uint8)
    counts = np.bincount(octets, minlength=256)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    disguised = DISGUISED.findall(text)
    hidden = sum(1 for w in disguised if (plain := w.lower().translate(PLAIN)) in INSULTS or plain in learned)
    same = (octets[1:] == octets[:-1]) & (octets[1:] >= 65)
    stretched = int((same[1:] & same[:-1]).sum()) if len(same) > 1 else 0
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper()) if upper else 0
    return [
        float(np.log1p(len(words))), lexicon / n, float(lexicon), weighed / n, weighed, max(weights.values(), default=0.0), float(len(weights)),
        float(near), len(second) / n, upper / (upper + lower + 1), shouted / n, counts[33] / n, counts[63] / n, marks / n,
        len(disguised) / n, float(hidden), stretched / n,
    ]


def copy_groups(words: list[list[str]], seeds: int = 6, shingle: int = 4) -> list[int]:
    """A number per list of words, shared by lists with a common smallest shingle hash: copies count once."""
    parent = list(range(len(words)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    met: dict[tuple[int, int], int] = {}
    factors = np.random.default_rng(5).integers(1, 1 << 62, seeds).astype(np.uint64) | np.uint64(1)
    for i, found in enumerate(words):
        hashes = np.array([zlib.crc32(" ".join(found[k : k + shingle]).encode()) for k in range(max(1, len(found) - shingle + 1))], np.uint64)
        for seed, low in enumerate((hashes[None] * factors[:, None]).min(axis=1).tolist()):
            j = met.setdefault((seed, low), i)
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(words))]


def learn_words(words: list[list[str]], labels: list[int], groups: list[int]) -> dict[str, float]:
    """Words with their smoothed log ratio of frequency in toxic and other groups of copies."""
    seen: dict[int, set] = {}
    toxic: dict[int, int] = {}
    for own, label, g in zip(words, labels, groups, strict=True):
        seen.setdefault(g, set()).update(own)
        toxic[g] = max(toxic.get(g, 0), label)
    bad, good = Counter(), Counter()
    for g, own in seen.items():
        (bad if toxic[g] else good).update(own)
    n_bad, n_good = sum(toxic.values()), len(toxic) - sum(toxic.values())
    weights = {w: float(np.log((k + 0.5) / (n_bad + 1) * (n_good + 1) / (good[w] + 0.5))) for w, k in bad.items() if k >= MIN_TOXIC}
    return {w: x for w, x in weights.items() if x >= MIN_WEIGHT}


@dataclass(frozen=True)
class Tree:
    """A complete tree: feature and threshold of each inner node (going right beyond it), value of each leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def value(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.threshold[node])
        return self.leaf[node - (2**DEPTH - 1)]


def grow(x: np.ndarray, binned: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, curve: np.ndarray) -> Tree:
    """One tree on the gradients ``slope`` and second derivatives ``curve`` of the loss."""
    inner = 2**DEPTH - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(x), np.int64)
    for at in range(inner):
        rows = np.flatnonzero(node == at)
        best = 1e-6
        for f in range(x.shape[1]) if len(rows) > 10 else ():
            if not len(edges[f]):
                continue
            g = np.bincount(binned[rows, f], slope[rows], len(edges[f]) + 1).cumsum()
            h = np.bincount(binned[rows, f], curve[rows], len(edges[f]) + 1).cumsum()
            gain = g**2 / (h + RIDGE) + (g[-1] - g) ** 2 / (h[-1] - h + RIDGE) - g[-1] ** 2 / (h[-1] + RIDGE)
            gain[(h < 1) | (h[-1] - h < 1)] = 0
            k = int(gain[:-1].argmax())
            if gain[k] > best:
                best, feature[at], threshold[at] = gain[k], f, edges[f][k]
        node[rows] = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
    leaves = node - inner
    g = np.bincount(leaves, slope, inner + 1)
    h = np.bincount(leaves, curve, inner + 1)
    return Tree(feature, threshold, -RATE * g / (h + RIDGE))


def boost(x: np.ndarray, y: np.ndarray) -> tuple[float, list[Tree]]:
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="lower")) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(x), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        trees.append(grow(x, binned, edges, p - y, p * (1 - p)))
        margin += trees[-1].value(x)
    return start, trees


def margins(x: np.ndarray, start: float, trees: list[Tree]) -> np.ndarray:
    return start + sum((t.value(x) for t in trees), np.zeros(len(x)))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the nearest rising step function, by pooling neighbours that fall."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum, number, first and last margin
    for m, label in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([label, 1, m, m])
        while len(blocks) > 1 and (blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1] or blocks[-2][3] == blocks[-1][2]):
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    at = np.array([b for s, n, a, z in blocks for b in ((a, z) if z > a else (a,))])
    to = np.array([v for s, n, a, z in blocks for v in ((s / n, s / n) if z > a else (s / n,))])
    return at, to


@dataclass(frozen=True)
class Model:
    learned: dict[str, float]
    start: float
    trees: list[Tree]
    at: np.ndarray
    to: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated probability of label 1 for each text."""
        x = np.array([features(t, self.learned) for t in texts], np.float64).reshape(len(texts), len(NAMES))
        return np.clip(np.interp(margins(x, self.start, self.trees), self.at, self.to), 0, 1)


def fit(sample: list[tuple[str, int]]) -> Model:
    """Words, trees and calibration from labelled texts. The margins behind the calibration come
    from models that have not seen the texts. With one label only, the score is its share."""
    y = np.array([label for _, label in sample], np.float64)
    if len(y) < 2 * FOLDS or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model({}, 0.0, [], np.array([0.0]), np.array([share]))
    texts, labels = [t for t, _ in sample], [label for _, label in sample]
    # each word is held once, however many texts it is in
    words = [[sys.intern(w) for w in words_of(t)] for t in texts]
    groups, words = copy_groups(words), [list(set(w)) for w in words]
    table = lambda learned: np.array([features(t, learned) for t in texts], np.float64)
    margin = np.zeros(len(y))
    # copies stay in one fold
    fold = np.array(groups) % FOLDS
    for k in range(FOLDS):
        rest = np.flatnonzero(fold != k)
        if not len(rest) or y[rest].min() == y[rest].max():
            continue
        x = table(learn_words([words[i] for i in rest], [labels[i] for i in rest], [groups[i] for i in rest]))
        margin[fold == k] = margins(x[fold == k], *boost(x[rest], y[rest]))
    learned = learn_words(words, labels, groups)
    x = table(learned)
    return Model(learned, *boost(x, y), *isotonic(margin, y))


def score(df: DataFrame, model: Model, columns: list[str], text: str = "text", into: str = "score") -> DataFrame:
    """``columns`` of ``df`` with the score (0 to 1) of the whole text as column ``into``.

    Null counts as empty. Rows are independent, repeated rows give repeated scores; no rows
    give no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value
        return lambda *values: [*values[:-1], known.score(values[-1])]

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)
    return map_texts(df, [*columns, text], kinds + f"`{into}` double", make)
