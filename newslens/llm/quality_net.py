"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned vector and one more input: whether the eight bytes from here on
also stand a few places before, which marks repetition. Filters of ``WIDTH`` bytes slide
over the whole text in steps of ``STRIDE``; their maxima are taken over chunks of 512 bytes
that overlap by 64. Each chunk passes a small hidden layer, and the mean and the maximum of
the chunks' outputs give one probability for the document.

The network is fitted with Adam on a bounded sample of labelled texts on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from newslens.llm.common import map_texts

SAMPLE = 2000
DIMS = 6
WIDTH = 8
STRIDE = 2
FILTERS = 24
HIDDEN = 16
PLACES = 32  # filter positions of a segment
SEGMENTS = 8  # segments of a chunk; the next chunk starts at its last one
LAGS = range(2, 25)
EPOCHS = 8
MIN_STEPS = 160  # small samples are gone through more often
BATCH = 64
RATE = 0.01
BLOCK = 1 << 16
SEED = 11


def lay_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, each text led by ``WIDTH`` zeros and closed by zeros to whole segments,
    and the segments of each. No filter sees two texts; a zero has the zero vector."""
    span = PLACES * STRIDE
    raw = [b"\0" * WIDTH + t.encode("utf-8") for t in texts]
    counts = np.array([-(-len(r) // span) for r in raw])
    return np.frombuffer(b"".join(r.ljust(c * span, b"\0") for r, c in zip(raw, counts.tolist(), strict=True)), np.uint8), counts


def echoes(octets: np.ndarray) -> np.ndarray:
    """1 where the eight bytes from here on also stand at one of the lags before, and are text."""
    wide = np.concatenate([octets, np.zeros(7, np.uint8)])
    eight = np.zeros(len(octets), np.uint64)
    for k in range(8):
        eight |= wide[k : k + len(octets)].astype(np.uint64) << np.uint64(8 * k)
    found = np.zeros(len(octets), bool)
    for lag in LAGS:
        found[lag:] |= eight[lag:] == eight[:-lag]
    return (found & (octets > 0)).astype(np.float32)


def chunk_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First segment and number of segments of every chunk, and the number of chunks of each text."""
    step = SEGMENTS - 1
    chunks = np.maximum(1, -(-(counts - 1) // step))
    begin = np.repeat(np.cumsum(counts) - counts, chunks)
    nth = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    return begin + nth * step, np.minimum(SEGMENTS, np.repeat(counts, chunks) - nth * step), chunks


@dataclass
class Network:
    vectors: np.ndarray  # of bytes
    filters: np.ndarray  # (WIDTH * (DIMS + 1), FILTERS)
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray  # over means, then maxima
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        vectors = draw(256, DIMS, scale=0.5)
        vectors[0] = 0
        return cls(
            vectors, draw(WIDTH * (DIMS + 1), FILTERS, scale=0.15), np.zeros(FILTERS, np.float32),
            draw(FILTERS, HIDDEN, scale=0.2), np.zeros(HIDDEN, np.float32), draw(2 * HIDDEN, scale=0.2), np.zeros(1, np.float32),
        )

    def windows(self, octets: np.ndarray) -> np.ndarray:
        """The inputs under a filter at each of its places, one row a place."""
        inputs = np.empty((len(octets) + WIDTH, DIMS + 1), np.float32)
        inputs[len(octets) :] = 0
        inputs[: len(octets), :DIMS] = self.vectors[octets]
        inputs[: len(octets), DIMS] = echoes(octets)
        step = inputs.strides[0]
        view = np.lib.stride_tricks.as_strided(inputs, (len(octets) // STRIDE, WIDTH * (DIMS + 1)), (STRIDE * step, inputs.itemsize))
        return np.ascontiguousarray(view)

    def chunk_maxima(self, peaks: np.ndarray, first: np.ndarray, number: np.ndarray) -> np.ndarray:
        best = peaks[first]
        for k in range(1, SEGMENTS):
            more = np.flatnonzero(number > k)
            best[more] = np.maximum(best[more], peaks[first[more] + k])
        return best

    def combine(self, pooled: np.ndarray, chunks: np.ndarray):
        act = np.maximum(pooled + self.bias, 0)
        z = np.tanh(act @ self.hidden + self.hidden_bias)
        at = np.cumsum(chunks) - chunks
        mean = np.add.reduceat(z, at, axis=0) / chunks[:, None]
        top = np.maximum.reduceat(z, at, axis=0)
        logit = np.concatenate([mean, top], axis=1) @ self.out + self.out_bias
        return act, z, mean, top, 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 for each text."""
        octets, counts = lay_out(texts)
        span = PLACES * STRIDE
        peaks = np.empty((len(octets) // span, FILTERS), np.float32)
        for at in range(0, len(octets), BLOCK):
            end = min(len(octets), at + BLOCK)
            fore = min(at, span)  # what lags and windows reach beyond the block
            rear = min(len(octets) - end, span)
            rows = self.windows(octets[at - fore : end + rear])[fore // STRIDE : (fore + end - at) // STRIDE]
            peaks[at // span : end // span] = (rows @ self.filters).reshape(-1, PLACES, FILTERS).max(axis=1)
        first, number, chunks = chunk_starts(counts)
        return self.combine(self.chunk_maxima(peaks, first, number), chunks)[-1]

    def gradients(self, texts: list[str], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        octets, counts = lay_out(texts)
        rows = self.windows(octets)
        maps = (rows @ self.filters).reshape(-1, PLACES, FILTERS)
        where = maps.argmax(axis=1)
        peaks = np.take_along_axis(maps, where[:, None], axis=1)[:, 0]
        place = where + np.arange(len(where))[:, None] * PLACES
        first, number, chunks = chunk_starts(counts)
        pooled, source = peaks[first].copy(), place[first].copy()
        for k in range(1, SEGMENTS):
            more = np.flatnonzero(number > k)
            better = peaks[first[more] + k] > pooled[more]
            pooled[more] = np.where(better, peaks[first[more] + k], pooled[more])
            source[more] = np.where(better, place[first[more] + k], source[more])
        act, z, mean, top, p = self.combine(pooled, chunks)
        d_logit = ((p - labels) * weights / len(texts)).astype(np.float32)
        owner = np.repeat(np.arange(len(texts)), chunks)
        d_z = (d_logit / chunks)[owner, None] * self.out[:HIDDEN] + (z == top[owner]) * d_logit[owner, None] * self.out[HIDDEN:]
        d_pre = d_z * (1 - z * z)
        d_act = (d_pre @ self.hidden.T) * (act > 0)
        under = rows[source]  # chunk, filter, input
        d_filters = np.einsum("cf,cfk->kf", d_act, under)
        d_inputs = (d_act[:, :, None] * self.filters.T[None]).reshape(-1, WIDTH, DIMS + 1)[:, :, :DIMS]
        letters = np.concatenate([octets, np.zeros(WIDTH, np.uint8)])[(source.reshape(-1, 1) * STRIDE) + np.arange(WIDTH)]
        d_vectors = np.stack([np.bincount(letters.ravel(), d_inputs[:, :, d].ravel(), 256) for d in range(DIMS)], axis=1)
        d_vectors[0] = 0
        return [
            d_vectors, d_filters, d_act.sum(axis=0), act.T @ d_pre, d_pre.sum(axis=0),
            np.concatenate([d_logit @ mean, d_logit @ top]), d_logit.sum(keepdims=True),
        ]


def fit(sample: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Fit by Adam; the two labels weigh alike in sum up to a factor of three. Without a sample,
    or with one label only, the network stays near its start."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    labels = np.array([y for _, y in sample], np.float64)
    if not len(labels) or labels.min() == labels.max():
        net.out[:] = 0
        net.out_bias[:] = 4 * (labels.mean() - 0.5) if len(labels) else 4
        return net
    share = np.array([1 - labels.mean(), labels.mean()])
    weight = np.clip(0.5 / share, None, 3 * (0.5 / share).min())[labels.astype(int)]
    names = list(net.__dataclass_fields__)
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    batches = -(-len(sample) // BATCH)
    epochs = max(epochs, -(-MIN_STEPS // batches))
    steps = epochs * batches
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(sample))
        for at in range(0, len(order), BATCH):
            step += 1
            chosen = order[at : at + BATCH]
            found = net.gradients([sample[i][0] for i in chosen], labels[chosen], weight[chosen])
            rate = RATE * (1 - 0.9 * step / steps)
            for name, g in zip(names, found, strict=True):
                g = g.astype(np.float32)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                move = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-7)
                getattr(net, name)[...] -= rate * move
    return net


def score(df: DataFrame, net: Network, columns: list[str], text: str = "text", into: str = "score") -> DataFrame:
    """``columns`` of ``df`` with the score (0 to 1) of the whole text as column ``into``.

    Null counts as empty; the empty text has a score of its own, the same for all. Rows are
    independent, repeated rows give repeated scores; no rows give no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(net)

    def make():
        known = shared.value
        return lambda *values: [*values[:-1], known.score([t or "" for t in values[-1]])]

    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)
    return map_texts(df, [*columns, text], kinds + f"`{into}` double", make)
