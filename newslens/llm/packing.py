"""Order-preserving packing of token sequences by dynamic programming.

Documents are laid end to end, each closed by an end token, in the order in which a task
reads them. Windows of at most ``length`` tokens cut this line; every token lies in exactly
one. A cut after a document is free, one after a sentence costs ``sentence_penalty`` tokens, so
that a document is cut where that saves more padding. Between ends that are more than ``grid``
tokens apart a cut is offered every ``grid`` tokens, for ``inner_penalty`` tokens: for sentences
longer than a window, and where the nearest end leaves very much padding. With
f(j) the least cost of windows up to cut j,

    f(j) = min over cuts i within ``length`` before j of f(i) + position(i)
           + length - position(j) + penalty(j),

a minimum over a sliding window, which a monotone queue yields in constant time per cut.
What is left at the end of a task's line is closed by windows whose lengths are powers of
two, which need no padding.

A line is worked through in stretches; the last, still open window of one is taken up by
the next, so memory does not grow with the task's input.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from newslens.llm.bpe import END, Vocabulary, coder_of
from newslens.llm.common import map_texts_with_end

LENGTH = 2048
END_TOKEN = 1
SENTENCE_PENALTY = 8
INNER_PENALTY = 192
GRID = 128
STRETCH = 1 << 18


def sentence_ends(vocabulary: Vocabulary) -> np.ndarray:
    """Per id, whether the token closes a sentence: punctuation that holds one of . ! ?"""
    shown = [t.removesuffix(END) for t in vocabulary.tokens]
    return np.array([t.endswith(END) and not any(c.isalnum() for c in s) and any(c in ".!?" for c in s) for t, s in zip(vocabulary.tokens, shown)])


def cuts(positions: np.ndarray, penalties: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Least cost and best earlier cut of each cut; the first cut is the start and costs nothing.

    Neighbouring positions must lie at most ``length`` apart.
    """
    place, extra = positions.tolist(), penalties.tolist()
    cost, back = [0] * len(place), [0] * len(place)
    key = [0] * len(place)  # cost + position
    key[0] = place[0]
    queue = deque([0])
    for j in range(1, len(place)):
        here = place[j]
        while place[queue[0]] < here - length:
            queue.popleft()
        i = queue[0]
        cost[j] = key[i] + length - here + extra[j]
        key[j] = k = cost[j] + here
        back[j] = i
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    return cost, back


class Packer:
    """Takes documents as token ids, returns finished pieces."""

    def __init__(self, ends: np.ndarray, base: int, length: int, sentence_penalty: int, inner_penalty: int, grid: int, with_ids: bool):
        self.with_ids = with_ids
        self.ends, self.length = ends, length
        self.sentence_penalty, self.inner_penalty, self.grid = sentence_penalty, inner_penalty, grid
        self.sequence = base
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[tuple] = []  # (key, tokens of the document, tokens already given out)

    def add(self, keys: list, flat: np.ndarray, counts: np.ndarray) -> list[list]:
        self.ids = np.r_[self.ids, flat.astype(np.uint32)]
        self.docs.extend(zip(keys, counts.tolist(), [0] * len(keys), strict=True))
        return self._close(False) if len(self.ids) >= STRETCH else []

    def _close(self, last: bool) -> list[list]:
        total = len(self.ids)
        if not total:
            return []
        left = np.array([n - given for _, n, given in self.docs], np.int64)
        given = np.array([g for _, _, g in self.docs], np.int64)
        stops = np.cumsum(left)
        begin = stops - left - given  # where a document would start had none of it been given out
        penalty = np.full(total + 1, -1, np.int64)
        penalty[1:][self.ends[self.ids]] = self.sentence_penalty
        penalty[stops] = 0
        penalty[0] = 0
        # between two ends further apart than so many tokens a cut elsewhere is offered
        own = np.flatnonzero(penalty >= 0)
        for a, b in zip(own[:-1][np.diff(own) > self.grid], own[1:][np.diff(own) > self.grid]):
            penalty[a + self.grid : b : self.grid] = self.inner_penalty
        positions = np.flatnonzero(penalty >= 0)
        cost, back = cuts(positions, penalty[positions], self.length)
        near = np.flatnonzero(positions >= total - self.length)
        j = int(near[np.argmin(np.array(cost)[near])])
        bounds = [int(positions[j])]
        while j:
            j = back[j]
            bounds.append(int(positions[j]))
        bounds.reverse()
        if last:
            rest = total - bounds[-1]
            for bit in range(rest.bit_length() - 1, -1, -1):
                if rest >> bit & 1:
                    bounds.append(bounds[-1] + (1 << bit))
        pieces = self._pieces(np.array(bounds, np.int64), stops, begin)
        upto = bounds[-1]
        first = int(np.searchsorted(stops, upto, "right"))
        self.docs = [(k, n, int(max(0, upto - begin[first + x]))) for x, (k, n, _) in enumerate(self.docs[first:])]
        self.ids = self.ids[upto:]
        return pieces

    def _pieces(self, bounds: np.ndarray, stops: np.ndarray, begin: np.ndarray) -> list[list]:
        if len(bounds) < 2:
            return []
        edges = np.union1d(bounds, stops[stops <= bounds[-1]])
        starts, lengths = edges[:-1], np.diff(edges)
        doc = np.searchsorted(stops, starts, "right")
        window = np.searchsorted(bounds, starts, "right") - 1
        raw = self.ids.astype("<u4").tobytes()
        columns = [
            [self.docs[d][0] for d in doc.tolist()],
            (starts - begin[doc]).tolist(),
            lengths.tolist(),
            [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)],
            [self.docs[d][1] for d in doc.tolist()],
            (self.sequence + window).tolist(),
            (starts - bounds[window]).tolist(),
        ]
        if self.with_ids:
            columns.append([self.ids[a : a + n].tolist() for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)])
        self.sequence += len(bounds) - 1
        return columns

    def end(self) -> list[list]:
        return self._close(True)


def pack(
    df: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end_token: int = END_TOKEN,
    sentence_penalty: int = SENTENCE_PENALTY, inner_penalty: int = INNER_PENALTY, grid: int = GRID, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start (tokens of its document before it), length, ids_crc32,
    doc_tokens, sequence_id, offset (its place in the sequence) and, unless left out, its ids.

    Null and empty texts are documents of the end token alone. Repeated rows, also rows with
    one id, are documents of their own; a null id stays null. No rows give no pieces. Sequence
    ids count up from 2^32 times the task's partition; a task that is run again reads the same
    rows and gives the same pieces. ``length`` must be a power of two.
    """
    if length < 1 or length & (length - 1) or not 1 <= grid <= length:
        raise ValueError("length must be a power of two, and grid between 1 and length")
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        coder, ends = coder_of(shared), sentence_ends(shared.value)
        packer = Packer(ends, TaskContext.get().partitionId() << 32, length, sentence_penalty, inner_penalty, grid, with_ids)

        def work(keys, texts):
            flat, counts = coder.encode(texts)
            flat = np.insert(flat, np.cumsum(counts), end_token)
            return packer.add(keys, flat, counts + 1)

        return work, packer.end

    kind = df.schema[doc_id].dataType.simpleString()
    ddl = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return map_texts_with_end(df, [doc_id, text], ddl + ", ids array<bigint>" * with_ids, make)
