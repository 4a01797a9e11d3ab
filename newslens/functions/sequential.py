"""The three change detectors with resets, advanced over an array of scores.

Each takes and returns a small plain-Python state, so the same code serves stored
sequences (slice by slice) and streams (micro-batch by micro-batch).

ADWIN: Bifet and Gavalda, "Learning from time-changing data with adaptive windowing" (2007).
KSWIN: Raab, Heusinger and Schleif, "Reactive soft prototype computing" (2020).
Page-Hinkley: Page, "Continuous inspection schemes" (1954), with a forgetting factor.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field
from functools import lru_cache

import numpy as np

# Fixed values.
ADWIN_DELTA = 0.002
KSWIN_WINDOW, KSWIN_RECENT, KSWIN_ALPHA = 100, 33, 0.005
PH_MIN_ROWS, PH_DELTA, PH_THRESHOLD, PH_FORGETTING = 30, 0.005, 50.0, 0.9999

ADWIN_CHECK_EVERY, ADWIN_BUCKETS_PER_SIZE, ADWIN_MIN_PART, ADWIN_GRACE = 32, 5, 5, 10
#: Rows that are inserted at once as long as there is no alarm, and what the Page-Hinkley sums are scaled by at most.
ADWIN_STRETCH, PH_STRETCH, PH_SCALE = 8192, 8192, 1e6


@dataclass(frozen=True)
class Settings:
    adwin_delta: float = ADWIN_DELTA
    kswin_alpha: float = KSWIN_ALPHA
    ph_delta: float = PH_DELTA
    ph_threshold: float = PH_THRESHOLD
    ph_forgetting: float = PH_FORGETTING
    ph_min_rows: int = PH_MIN_ROWS
    seed: int = 42


@dataclass
class DetectorState:
    rows: int = 0
    # buckets[i] holds (sum, squared deviation) of spans of 2**i rows, oldest first.
    buckets: list = field(default_factory=list)
    # Newest scores, and how many of them the KSWIN window holds.
    recent: list = field(default_factory=list)
    held: int = 0
    # rows, mean, rise, lowest rise, fall, highest fall since the last Page-Hinkley alarm.
    page_hinkley: list = field(default_factory=lambda: [0, 0.0, 0.0, math.inf, 0.0, -math.inf])

    def dumps(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def loads(cls, text: str | None) -> DetectorState:
        return cls(**json.loads(text)) if text else cls()


def adwin_bound(variance, n0, n1, n, delta):
    """Smallest difference of means that counts as a change (NumPy arrays or numbers)."""
    harmonic = 1.0 / n0 + 1.0 / n1
    log_term = np.log(2.0 * np.log(n) / delta)
    return np.sqrt(2.0 * harmonic * variance * log_term) + 2.0 / 3.0 * harmonic * log_term


def _flat(buckets: list) -> np.ndarray:
    """Size, sum and squared deviation of all buckets, oldest first."""
    return np.array([(2.0**i, s, d) for i in range(len(buckets) - 1, -1, -1) for s, d in buckets[i]]).reshape(-1, 3)


def _cuts_found(size: np.ndarray, total: np.ndarray, within: np.ndarray, delta: float) -> np.ndarray:
    """For each row of buckets (oldest first, empty places zero): does some cut separate two different means?"""
    n, whole = size.sum(axis=1, keepdims=True), total.sum(axis=1, keepdims=True)
    usable_rows = n[:, 0] > ADWIN_GRACE
    if not usable_rows.any():
        return usable_rows
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = whole / n
        apart = np.where(size > 0, size * (total / size - mean) ** 2, 0.0)
        variance = (within.sum(axis=1, keepdims=True) + apart.sum(axis=1, keepdims=True)) / n
        n0, s0 = np.cumsum(size, axis=1), np.cumsum(total, axis=1)
        n1 = n - n0
        usable = (n0 >= ADWIN_MIN_PART) & (n1 >= ADWIN_MIN_PART) & usable_rows[:, None]
        return (usable & (np.abs(s0 / n0 - (whole - s0) / n1) > adwin_bound(variance, n0, n1, n, delta))).any(axis=1)


def _shrink(buckets: list, delta: float) -> bool:
    """Drop oldest buckets while some cut separates two different means."""
    shrunk = False
    while len(spans := _flat(buckets)) > 1 and _cuts_found(*(c[None] for c in spans.T), delta)[0]:
        shrunk = True
        buckets[-1].pop(0)
        while buckets and not buckets[-1]:
            buckets.pop()
    return shrunk


def _queues(buckets: list, values: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Per level all buckets it holds while ``values`` arrive, oldest first, and how many it held before.

    A full level merges its two oldest buckets, so what a level hands on are the pairs of its
    queue from the front, whenever that happens."""
    arriving = np.stack([values, np.zeros(len(values))], axis=1)
    out, level = [], 0
    while level < len(buckets) or len(arriving):
        held = np.array(buckets[level], float).reshape(-1, 2) if level < len(buckets) else np.zeros((0, 2))
        queue = np.concatenate([held, arriving])
        out.append((queue, len(held)))
        pairs = max(0, (len(queue) - ADWIN_BUCKETS_PER_SIZE + 1) // 2)
        old, new = queue[0 : 2 * pairs : 2], queue[1 : 2 * pairs : 2]
        arriving = np.stack([old[:, 0] + new[:, 0], old[:, 1] + new[:, 1] + (old[:, 0] - new[:, 0]) ** 2 / 2 ** (level + 1)], axis=1)
        level += 1
    return out


def _held_after(queues: list, arrived: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the first and the last place (exclusive) of its queue that it holds once ``arrived`` values are in."""
    places, come = [], arrived
    for _, before in queues:
        last = before + come
        come = np.maximum(0, (last - ADWIN_BUCKETS_PER_SIZE + 1) // 2)
        places.append((2 * come, last))
    return places


def run_adwin(state: DetectorState, values: np.ndarray, delta: float) -> np.ndarray:
    """Alarms of the adaptive window, tested at every 32nd row.

    Without an alarm the buckets at each test follow from the levels' queues, so a stretch of
    rows is inserted level by level and all its tests are made at once. The stretch ends at the
    first alarm, where the window is cut; the next one is as long again as the last was good for.
    """
    flags = np.zeros(len(values), dtype=bool)
    at, stretch = 0, ADWIN_STRETCH
    while at < len(values):
        part = values[at : at + stretch]
        tests = np.arange(ADWIN_CHECK_EVERY - (state.rows + at) % ADWIN_CHECK_EVERY, len(part) + 1, ADWIN_CHECK_EVERY)
        queues = _queues(state.buckets, part)
        found = np.flatnonzero(_tests(queues, tests, delta)) if len(tests) else ()
        used = int(tests[found[0]]) if len(found) else len(part)
        held = _held_after(queues, np.array([used]))
        state.buckets[:] = [[tuple(b) for b in queue[first[0] : last[0]].tolist()] for (queue, _), (first, last) in zip(queues, held)]
        while state.buckets and not state.buckets[-1]:
            state.buckets.pop()
        if len(found):
            _shrink(state.buckets, delta)
            flags[at + used - 1] = True
        at += used
        stretch = min(ADWIN_STRETCH, max(2 * used, 4 * ADWIN_CHECK_EVERY)) if len(found) else min(ADWIN_STRETCH, 2 * stretch)
    return flags


def _tests(queues: list, tests: np.ndarray, delta: float) -> np.ndarray:
    """Whether there is a change after each number of arrived values in ``tests``."""
    wide = ADWIN_BUCKETS_PER_SIZE
    size, total, within = (np.zeros((len(tests), wide * len(queues))) for _ in range(3))
    for level, ((queue, _), (first, last)) in enumerate(zip(queues, _held_after(queues, tests))):
        place = first[:, None] + np.arange(wide)
        there = place < last[:, None]
        if not there.any():
            continue
        taken = queue[np.minimum(place, len(queue) - 1)]
        columns = slice(wide * (len(queues) - 1 - level), wide * (len(queues) - level))
        size[:, columns] = there * 2.0**level
        total[:, columns], within[:, columns] = there * taken[:, :, 0], there * taken[:, :, 1]
    return _cuts_found(size, total, within, delta)


@lru_cache
def ks_critical(n: int, alpha: float) -> int:
    """Smallest k for which D = k/n of two samples of size n has an exact p-value <= alpha."""
    whole = math.comb(2 * n, n)
    for k in range(1, n + 1):
        tail = sum((-1) ** (j - 1) * math.comb(2 * n, n - j * k) for j in range(1, n // k + 1))
        if 2 * tail / whole <= alpha:
            return k
    return n + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ks_changed(windows: np.ndarray, last_rows: np.ndarray, seed: int, alpha: float) -> np.ndarray:
    """For each window of 100 scores: do its newest 33 differ from 33 random older ones?

    The random choice depends only on ``seed`` and the row number, so any slicing of the
    sequence gives the same answer.
    """
    old, recent = windows[:, :-KSWIN_RECENT], windows[:, -KSWIN_RECENT:]
    slots = np.arange(old.shape[1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        # The row is mixed first: otherwise neighbouring rows would repeat each other's draws.
        draw = _mix(_mix(last_rows.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) + slots[None, :] * np.uint64(0xD1342543DE82EF95))
    picked = np.argpartition(draw, KSWIN_RECENT - 1, axis=1)[:, :KSWIN_RECENT]
    both = np.concatenate([np.take_along_axis(old, picked, axis=1), recent], axis=1)
    order = np.argsort(both, axis=1, kind="stable")
    both = np.take_along_axis(both, order, axis=1)
    gap = np.cumsum(np.where(order < KSWIN_RECENT, 1, -1), axis=1)
    last_of_tie = np.ones(both.shape, dtype=bool)
    last_of_tie[:, :-1] = both[:, 1:] != both[:, :-1]
    return np.abs(np.where(last_of_tie, gap, 0)).max(axis=1) >= ks_critical(KSWIN_RECENT, alpha)


def kswin_changes(values: np.ndarray, last_row: int, seed: int, alpha: float, chunk: int = 20_000) -> np.ndarray:
    """The test at every position of consecutive ``values``, of which the last is row
    ``last_row``; False where fewer than 99 values precede. Needs no state."""
    changed = np.zeros(len(values), dtype=bool)
    if len(values) >= KSWIN_WINDOW:
        windows = np.lib.stride_tricks.sliding_window_view(values, KSWIN_WINDOW)
        rows = last_row - len(values) + KSWIN_WINDOW + np.arange(len(windows))
        for start in range(0, len(windows), chunk):
            part = slice(start, start + chunk)
            changed[KSWIN_WINDOW - 1 :][part] = ks_changed(windows[part], rows[part], seed, alpha)
    return changed


def spaced(places: np.ndarray, first: int, apart: int = KSWIN_WINDOW - KSWIN_RECENT) -> list[int]:
    """Of rising ``places`` the first at ``first`` or later, and so on, each ``apart`` or more after the last."""
    out, at = [], np.searchsorted(places, first)
    while at < len(places):
        out.append(int(places[at]))
        at = np.searchsorted(places, out[-1] + apart)
    return out


def run_kswin(state: DetectorState, values: np.ndarray, alpha: float, seed: int, changed: np.ndarray | None = None) -> np.ndarray:
    """Alarms: the changes found while the window is full. An alarm leaves it 33 rows, so the
    next one comes 67 rows later at the earliest. ``changed`` may hold the tests' outcome."""
    joined = np.concatenate([np.array(state.recent, dtype=float), values])
    if changed is None:
        changed = kswin_changes(joined, state.rows + len(values), seed, alpha)[len(state.recent) :]
    flags = np.zeros(len(values), dtype=bool)
    alarms = spaced(np.flatnonzero(changed), KSWIN_WINDOW - 1 - state.held)
    flags[alarms] = True
    held, seen = (KSWIN_RECENT, alarms[-1] + 1) if alarms else (state.held, 0)
    state.held = min(held + len(values) - seen, KSWIN_WINDOW)
    state.recent = joined[-(KSWIN_WINDOW - 1) :].tolist()
    return flags


def run_page_hinkley(state: DetectorState, values: np.ndarray, s: Settings) -> np.ndarray:
    """Alarms of the Page-Hinkley test. A stretch of rows is summed at once up to its first alarm:
    the discounted sums are prefix sums of scaled values."""
    flags = np.zeros(len(values), dtype=bool)
    n, mean, rise, low, fall, high = state.page_hinkley
    longest = PH_STRETCH if s.ph_forgetting >= 1 else max(1, min(PH_STRETCH, int(math.log(PH_SCALE) / -math.log(s.ph_forgetting))))
    at, stretch = 0, longest
    while at < len(values):
        part = values[at : at + stretch]
        seen = n + 1 + np.arange(len(part))
        means = (n * mean + np.cumsum(part)) / seen
        weight = s.ph_forgetting ** np.arange(1, len(part) + 1)
        rises = weight * (rise + np.cumsum((part - means - s.ph_delta) / weight))
        falls = weight * (fall + np.cumsum((part - means + s.ph_delta) / weight))
        lows, highs = np.minimum(low, np.minimum.accumulate(rises)), np.maximum(high, np.maximum.accumulate(falls))
        over = (seen >= s.ph_min_rows) & ((rises - lows > s.ph_threshold) | (highs - falls > s.ph_threshold))
        if over.any():
            used = int(over.argmax()) + 1
            flags[at + used - 1] = True
            n, mean, rise, low, fall, high = 0, 0.0, 0.0, math.inf, 0.0, -math.inf
            stretch = min(longest, max(2 * used, 64))
        else:
            used = len(part)
            n, mean, rise, low, fall, high = n + used, *(float(v[-1]) for v in (means, rises, lows, falls, highs))
            stretch = min(longest, 2 * stretch)
        at += used
    state.page_hinkley = [n, mean, rise, low, fall, high]
    return flags


def run_detectors(
    state: DetectorState, values: np.ndarray, s: Settings, changed: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Advance ``state`` over sanitised scores; one flag array per detector. ``changed`` are
    the KSWIN tests if they have been made already."""
    values = np.asarray(values, dtype=float)
    found = (
        run_adwin(state, values, s.adwin_delta),
        run_kswin(state, values, s.kswin_alpha, s.seed, changed),
        run_page_hinkley(state, values, s),
    )
    state.rows += len(values)
    return found
