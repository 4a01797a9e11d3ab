"""Notifications of alert groups: a wait before the first, an interval between changes, a repeat.

A group comes to life when one of its alerts fires. It looks at its alerts after the wait and then
every interval: it tells of alerts that fire now but were not told of, and of those that are
over; what has not changed is told again when the repeat time has passed. A look that finds
nothing firing ends the group. Time is event time: a look takes place once a later tick is known.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Fixed values.
GROUP_WAIT, GROUP_INTERVAL, REPEAT_INTERVAL = 30, 5 * 60, 60 * 60
GROUP_BY = ("alertname",)

MICROS = 1_000_000
MESSAGE = T.StructType(
    [
        T.StructField("sent_micros", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("firing", T.ArrayType(T.StringType())),
        T.StructField("resolved", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Timing:
    """Seconds."""

    wait: int = GROUP_WAIT
    interval: int = GROUP_INTERVAL
    repeat: int = REPEAT_INTERVAL


@dataclass
class Group:
    """What a group remembers between ticks; times in microseconds."""

    firing: dict[str, bool] = field(default_factory=dict)
    told: list[str] = field(default_factory=list)
    next_look: int | None = None
    last_sent: int = 0
    # ticks that have come but lie behind the watermark's promise
    waiting: list = field(default_factory=list)

    def dumps(self) -> str:
        return json.dumps(self.__dict__)

    def looks(self, until: int, timing: Timing) -> Iterator[tuple[int, str, list[str], list[str]]]:
        """The messages of all looks up to ``until``."""
        while self.next_look is not None and self.next_look <= until:
            now, self.next_look = self.next_look, self.next_look + timing.interval * MICROS
            firing = sorted(u for u, on in self.firing.items() if on)
            over = sorted(set(self.told) - set(firing))
            if not firing:
                if over:
                    yield now, "resolved", [], over
                self.told, self.next_look, self.firing = [], None, {}
            elif over or set(firing) - set(self.told):
                yield now, "firing", firing, over
                self.told, self.last_sent = firing, now
            elif now - self.last_sent >= timing.repeat * MICROS:
                yield now, "repeat", firing, []
                self.last_sent = now

    def tick(self, at: int, states: Iterable[tuple[str, bool]], timing: Timing) -> Iterator[tuple[int, str, list[str], list[str]]]:
        """Looks before ``at``, then the states of that tick."""
        yield from self.looks(at - 1, timing)
        self.firing.update(states)
        if self.next_look is None and any(self.firing.values()):
            self.next_look = at + timing.wait * MICROS


def _prepared(states: DataFrame, time: str, uid: str) -> DataFrame:
    return states.withColumns({"_at": F.unix_micros(F.col(time).cast("timestamp")), "_uid": F.col(uid), "_on": F.col("state") == "Alerting"})


def _by_tick(rows: pd.DataFrame) -> Iterator[tuple[int, list[tuple[str, bool]]]]:
    ordered = rows.sort_values(["_at", "_uid"], kind="stable")
    for at, some in ordered.groupby("_at", sort=False):
        yield int(at), list(zip(some["_uid"], some["_on"].astype(bool)))


def _sent(messages: DataFrame, group_by: Sequence[str]) -> DataFrame:
    return messages.select(*group_by, F.timestamp_micros("sent_micros").alias("sent_at"), "kind", "firing", "resolved")


def grouped_notifications(
    states: DataFrame, group_by: Sequence[str] = GROUP_BY, timing: Timing = Timing(), *, time: str = "tick", uid: str = "uid"
) -> DataFrame:
    """Messages of every group: its columns, ``sent_at``, ``kind`` (firing, repeat, resolved), and the
    alerts that fire and that are over.

    ``states`` has a state per alert and tick, as of ``alert_states`` with ``rule_titles``. A group's
    rows are one per minute and rule: five million for ten years, whatever the number of articles.
    Looks after the last tick of all have not taken place yet.
    """
    prepared = _prepared(states, time, uid)
    end = prepared.agg(F.max("_at")).first()[0]
    schema = T.StructType([*[states.schema[c] for c in group_by], *MESSAGE.fields])

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        group, out = Group(), []
        for at, some in _by_tick(rows):
            out += group.tick(at, some, timing)
        out += group.looks(end, timing)
        made = pd.DataFrame(out, columns=[f.name for f in MESSAGE])
        return made.assign(**{c: rows[c].iloc[0] for c in group_by})[[f.name for f in schema]]

    return _sent(prepared.groupBy(*group_by).applyInPandas(walk, schema), group_by)


def notification_stream(
    states: DataFrame, group_by: Sequence[str] = GROUP_BY, timing: Timing = Timing(), *, time: str = "tick", uid: str = "uid", delay: str = "1 minute"
) -> DataFrame:
    """``grouped_notifications`` of a stream. Ticks may come out of order by ``delay``.

    Rows wait in the group's state until the watermark has passed them, so the messages are those
    of the batch. The next look is an event-time timer, so a group whose ticks stop is heard of
    as soon as others move time on. ``time`` must be a timestamp with time zone.
    """
    prepared = _prepared(states, time, uid).withWatermark(time, delay)
    schema = T.StructType([*[states.schema[c] for c in group_by], *MESSAGE.fields])
    kept = T.StructType([T.StructField("group", T.StringType())])

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        group = Group(**json.loads(state.get[0])) if state.exists else Group()
        passed = state.getCurrentWatermarkMs() * 1000
        if not state.hasTimedOut:
            for rows in batches:
                group.waiting += [[int(at), u, bool(on)] for at, u, on in zip(rows["_at"], rows["_uid"], rows["_on"])]
        group.waiting.sort()
        ready = [w for w in group.waiting if w[0] <= passed]
        group.waiting = group.waiting[len(ready) :]
        out = []
        for at, some in groupby(ready, key=lambda w: w[0]):
            out += group.tick(at, [(u, on) for _, u, on in some], timing)
        out += group.looks(passed, timing)
        wake = [t for t in (group.next_look, group.waiting[0][0] if group.waiting else None) if t is not None]
        state.update((group.dumps(),))
        if wake:
            state.setTimeoutTimestamp(max(min(wake) // 1000, passed // 1000) + 1)
        yield pd.DataFrame(out, columns=[f.name for f in MESSAGE]).assign(**dict(zip(group_by, key)))[[f.name for f in schema]]

    walked = prepared.groupBy(*group_by).applyInPandasWithState(advance, schema, kept, "append", GroupStateTimeout.EventTimeTimeout)
    return _sent(walked, group_by)
