"""Change detection over the score sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import register
from catalog.article_queries import rounded
from catalog.drift_queries import ORDER
from catalog.views import SCORED, scored_events
from newslens.functions.sequential import Settings
from newslens.operators import detectors as ops
from newslens.operators import drift

NUMBERED = (
    SCORED
    + """, numbered AS (SELECT source, p_fake AS x, row_number() OVER (PARTITION BY source ORDER BY processed_at, id) AS idx FROM scored)"""
)

SHIFT_SQL = "CASE WHEN day(processed_at) // 2 % 2 = 1 THEN p_fake * 0.2e0 ELSE p_fake END"
#: Threshold of the Page-Hinkley test in the queries of the whole monitor: at 50 it keeps still on these scores.
PH_THRESHOLD_SQL = 4.0
QUICK = Settings(ph_threshold=PH_THRESHOLD_SQL)


def sequence(spark, sf):
    return scored_events(spark, sf).select("id", "source", "processed_at", "p_fake")


CUTS = (
    NUMBERED
    + """, b AS (SELECT source, (idx - 1) // 50 AS bucket, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM numbered GROUP BY 1, 2),
p AS (SELECT source, sum(n) OVER w AS n0, sum(s) OVER w AS s0, sum(n) OVER t AS n, sum(s) OVER t AS s, sum(q) OVER t AS q
  FROM b WINDOW w AS (PARTITION BY source ORDER BY bucket ROWS UNBOUNDED PRECEDING), t AS (PARTITION BY source)),
m AS (SELECT *, 1e0 / n0 + 1e0 / (n - n0) AS h, ln(2 * ln(n) / 0.002e0) AS l, q / n - (s / n) * (s / n) AS v FROM p WHERE n0 < n),
cuts AS (SELECT source, CAST(n0 AS BIGINT) AS cut, abs(s0 / n0 - (s - s0) / (n - n0)) AS gap,
  sqrt(2 * h * v * l) + 2e0 / 3 * h * l AS bound FROM m)"""
)


@register(
    "adwin_cuts",
    f"WITH {CUTS} SELECT source, cut, round(gap, 6) AS gap, round(bound, 6) AS bound, gap > bound AS changed FROM cuts",
)
def adwin_cuts(spark, sf):
    return rounded(ops.adwin_cuts(sequence(spark, sf), ORDER, ["source"]), "gap", "bound")


@register(
    "adwin_cuts_global",
    f"""WITH {CUTS.replace('PARTITION BY source ORDER BY processed_at', 'ORDER BY processed_at')
        .replace('source, (idx', '1 AS source, (idx')}
SELECT cut, round(gap, 6) AS gap, round(bound, 6) AS bound, gap > bound AS changed FROM cuts""",
)
def adwin_cuts_global(spark, sf):
    return rounded(ops.adwin_cuts(sequence(spark, sf), ORDER), "gap", "bound")


@register(
    "adwin_summary",
    f"""WITH {CUTS} SELECT source, count(*) AS cuts, count(*) FILTER (WHERE gap > bound) AS changes,
  arg_max(cut, gap - bound) FILTER (WHERE gap > bound) AS strongest_cut FROM cuts GROUP BY 1""",
)
def adwin_summary(spark, sf):
    return ops.adwin_summary(ops.adwin_cuts(sequence(spark, sf), ORDER, ["source"]), ["source"])


@register(
    "kswin_blocks",
    f"""WITH {NUMBERED}, w AS (SELECT source, (idx - 1) // 100 AS window_index, x, CASE WHEN (idx - 1) % 100 >= 67 THEN 1 ELSE 0 END AS r FROM numbered),
d AS (SELECT source, window_index, abs(sum(r) OVER u / 33e0 - sum(1 - r) OVER u / 67e0) AS d FROM w
  WINDOW u AS (PARTITION BY source, window_index ORDER BY x RANGE UNBOUNDED PRECEDING))
SELECT source, CAST(window_index AS BIGINT) AS window_index, round(max(d), 6) AS distance,
  max(d) > sqrt(-0.5e0 * ln(0.005e0 / 2)) * sqrt(100 / (33e0 * 67)) AS changed
FROM d GROUP BY 1, 2 HAVING count(*) = 100""",
)
def kswin_blocks(spark, sf):
    return rounded(ops.kswin_blocks(sequence(spark, sf), ORDER, ["source"]), "distance")


_FOLD = """list_reduce(list({{'x': x, 'n': 0::BIGINT, 'mean': 0e0, 'rise': 0e0, 'low': 'Infinity'::DOUBLE, 'fall': 0e0, 'high': '-Infinity'::DOUBLE,
    'stat': 0e0, 'peak': 0e0, 'alarms': []::BIGINT[]}} ORDER BY idx), LAMBDA a, e:
  (LAMBDA_BODY), {{'x': 0e0, 'n': 0::BIGINT, 'mean': 0e0, 'rise': 0e0, 'low': 'Infinity'::DOUBLE, 'fall': 0e0, 'high': '-Infinity'::DOUBLE,
    'stat': 0e0, 'peak': 0e0, 'alarms': []::BIGINT[]}})"""


def _page_hinkley_sql(threshold: float, reset: bool) -> str:
    """The statistic walked row by row with a list fold, independent of the window form."""
    mean = "(a.mean + (e.x - a.mean) / (a.n + 1))"
    if not reset:
        n, rise, fall, low, high = "a.n", "a.rise", "a.fall", "a.low", "a.high"
    else:
        # A row after an alarm starts from scratch.
        over = f"(a.n >= 30 AND a.stat > {threshold}e0)"
        n, rise, fall = (f"(CASE WHEN {over} THEN 0 ELSE a.{c} END)" for c in ("n", "rise", "fall"))
        low = f"(CASE WHEN {over} THEN 'Infinity'::DOUBLE ELSE a.low END)"
        high = f"(CASE WHEN {over} THEN '-Infinity'::DOUBLE ELSE a.high END)"
        m = f"(CASE WHEN {over} THEN 0e0 ELSE a.mean END)"
        mean = f"({m} + (e.x - {m}) / ({n} + 1))"
    new_rise = f"(0.9999e0 * {rise} + (e.x - {mean} - 0.005e0))"
    new_fall = f"(0.9999e0 * {fall} + (e.x - {mean} + 0.005e0))"
    new_low, new_high = f"least({low}, {new_rise})", f"greatest({high}, {new_fall})"
    stat = f"greatest({new_rise} - {new_low}, {new_high} - {new_fall})"
    body = (
        f"{{'x': a.x + 1, 'n': {n} + 1, 'mean': {mean}, 'rise': {new_rise}, 'low': {new_low}, 'fall': {new_fall}, "
        f"'high': {new_high}, 'stat': {stat}, 'peak': greatest(a.peak, {stat}), "
        f"'alarms': CASE WHEN {n} + 1 >= 30 AND {stat} > {threshold}e0 THEN list_append(a.alarms, (a.x + 1)::BIGINT) ELSE a.alarms END}}"
    )
    return _FOLD.format().replace("(LAMBDA_BODY)", body)


@register(
    "page_hinkley_first",
    f"""WITH {NUMBERED}, f AS (SELECT source, count(*) AS rows, {_page_hinkley_sql(5.0, False)} AS s FROM numbered GROUP BY source)
SELECT source, s.alarms[1] AS first_alarm, round(s.peak, 6) AS peak, rows FROM f""",
)
def page_hinkley_first(spark, sf):
    found = ops.page_hinkley_first(sequence(spark, sf), ORDER, ["source"], threshold=5.0)
    return rounded(found, "peak")


@register(
    "page_hinkley_resets",
    f"""WITH {NUMBERED}, f AS (SELECT source, {_page_hinkley_sql(5.0, True)} AS s FROM numbered GROUP BY source)
SELECT source, unnest(s.alarms) AS message_index FROM f""",
)
def page_hinkley_resets(spark, sf):
    found = ops.detect(sequence(spark, sf), ORDER, ["source"], settings=Settings(ph_threshold=5.0))
    return drift.message_index(found, ORDER, ["source"]).filter("page_hinkley").select("source", "message_index")


#: Scores that fall every other two days, so that all detectors raise alarms, now and then at one row.
SHIFTED = NUMBERED.replace("p_fake AS x", f"{SHIFT_SQL} AS x, id, p_fake, processed_at")


def shifted(spark, sf):
    return sequence(spark, sf).withColumn("p_fake", F.when(F.floor(F.dayofmonth("processed_at") / 2) % 2 == 1, F.col("p_fake") * 0.2).otherwise(F.col("p_fake")))


def _level_sql(level: int, inner: str) -> str:
    """Buckets ``b`` (level, sum, squared deviation; oldest first) after the full level has merged its oldest pairs."""
    old, new = "b[h + 2 * i - 1]", "b[h + 2 * i]"
    return f"""SELECT * EXCLUDE (b, h, m), b[1:h] || list_transform(range(1, m + 1), LAMBDA i: {{'l': {level + 1}, 's': {old}.s + {new}.s,
      'd': {old}.d + {new}.d + ({old}.s - {new}.s) * ({old}.s - {new}.s) / {2.0 ** (level + 1)}e0}}) || b[h + 2 * m + 1:] AS b
    FROM (SELECT *, len(list_filter(b, LAMBDA e: e.l > {level})) AS h, greatest(0, (len(list_filter(b, LAMBDA e: e.l = {level})) - 4) // 2) AS m FROM ({inner}))"""


def _adwin_sql(levels: int = 18) -> str:
    """The adaptive window walked test by test: 32 rows come in, then oldest buckets go one by one while a cut shows."""
    merged = """SELECT w.source, c.c, w.again, CASE WHEN w.again THEN w.b ELSE w.b || c.fresh END AS b
      FROM adwin_walk w JOIN chunks c ON c.source = w.source AND c.c = CASE WHEN w.again THEN w.c ELSE w.c + 1 END"""
    for level in range(levels):
        merged = _level_sql(level, merged)
    return f"""chunks AS (
  SELECT source, (idx - 1) // 32 AS c, list({{'l': 0, 's': x, 'd': 0e0}} ORDER BY idx) AS fresh FROM numbered GROUP BY ALL HAVING count(*) = 32),
adwin_walk AS (
  SELECT DISTINCT source, CAST(-1 AS BIGINT) AS c, false AS again, CAST([] AS STRUCT(l INTEGER, s DOUBLE, d DOUBLE)[]) AS b FROM numbered
  UNION ALL
  SELECT source, c, cut AS again, CASE WHEN cut THEN b[2:] ELSE b END AS b FROM (
    SELECT *, n > 10 AND len(list_filter(range(1, len(b)), LAMBDA j:
      n0s[j] >= 5 AND n - n0s[j] >= 5 AND abs(s0s[j] / n0s[j] - (t - s0s[j]) / (n - n0s[j]))
        > sqrt(2 * (1 / n0s[j] + 1 / (n - n0s[j])) * v * g) + 2e0 / 3 * (1 / n0s[j] + 1 / (n - n0s[j])) * g)) > 0 AS cut
    FROM (
      SELECT *, ln(2 * ln(n) / 0.002e0) AS g, list_sum(list_transform(b, LAMBDA e: e.d + pow(2e0, e.l) * pow(e.s / pow(2e0, e.l) - t / n, 2))) / n AS v,
        list_transform(range(1, len(b)), LAMBDA j: list_sum(list_transform(b[1:j], LAMBDA e: pow(2e0, e.l)))) AS n0s,
        list_transform(range(1, len(b)), LAMBDA j: list_sum(list_transform(b[1:j], LAMBDA e: e.s))) AS s0s
      FROM (SELECT *, list_sum(list_transform(b, LAMBDA e: pow(2e0, e.l))) AS n, list_sum(list_transform(b, LAMBDA e: e.s)) AS t FROM ({merged})))) ),
adwin AS (SELECT DISTINCT source, (c + 1) * 32 AS idx FROM adwin_walk WHERE again)"""


def _times(a: str, b: int) -> str:
    return f"CAST((CAST({a} AS UHUGEINT) * {b}) % 18446744073709551616 AS UBIGINT)"


def _plus(a: str, b: str) -> str:
    return f"CAST((CAST({a} AS UHUGEINT) + CAST({b} AS UHUGEINT)) % 18446744073709551616 AS UBIGINT)"


def _mixed(x: str, name: str) -> tuple[str, list[str]]:
    """Steps that mix the bits of ``x`` into column ``name``."""
    steps = [f"xor({x}, {x} >> 30) AS {name}0", f"{_times(f'{name}0', 0xBF58476D1CE4E5B9)} AS {name}1", f"xor({name}1, {name}1 >> 27) AS {name}2"]
    return name, [*steps, f"{_times(f'{name}2', 0x94D049BB133111EB)} AS {name}3", f"xor({name}3, {name}3 >> 31) AS {name}"]


def _nested(inner: str, steps: list[str]) -> str:
    for step in steps:
        inner = f"SELECT *, {step} FROM ({inner})"
    return inner


#: The KSWIN detector row by row: 33 of the 67 older scores by a hash, the distance of two samples of 33
#: (14 steps of 1/33 are the least that have a chance of 0.005 or less), and 67 rows of rest after an alarm.
_ROW_DRAW = _nested(f"SELECT source, idx, {_plus(_times('CAST(idx AS UBIGINT)', 0x9E3779B97F4A7C15), '42')} AS k FROM numbered WHERE idx >= 100", _mixed("k", "r")[1])
_SLOT_DRAW = _nested(
    f"SELECT d.source, d.idx, n.x, {_plus('d.r', _times('CAST(n.idx - (d.idx - 99) AS UBIGINT)', 0xD1342543DE82EF95))} AS q"
    f" FROM ({_ROW_DRAW}) d JOIN numbered n ON n.source = d.source AND n.idx BETWEEN d.idx - 99 AND d.idx - 33",
    _mixed("q", "z")[1],
)
KSWIN = f"""picked AS (
  SELECT source, idx, x, 1 AS side FROM (SELECT *, row_number() OVER (PARTITION BY source, idx ORDER BY z) AS place FROM ({_SLOT_DRAW})) WHERE place <= 33
  UNION ALL
  SELECT d.source, d.idx, n.x, -1 FROM numbered d JOIN numbered n ON n.source = d.source AND n.idx BETWEEN d.idx - 32 AND d.idx WHERE d.idx >= 100),
tested AS (
  SELECT source, idx FROM (SELECT source, idx, abs(sum(side) OVER (PARTITION BY source, idx ORDER BY x RANGE UNBOUNDED PRECEDING)) AS gap FROM picked)
  GROUP BY ALL HAVING max(gap) >= 14),
kswin AS (
  SELECT source, unnest(list_reduce(list([idx] ORDER BY idx), LAMBDA a, e: CASE WHEN e[1] >= a[-1] + 67 THEN list_append(a, e[1]) ELSE a END, [CAST(-67 AS BIGINT)])[2:]) AS idx
  FROM tested GROUP BY source)"""

VOTES = (
    SHIFTED.replace("WITH ", "", 1)
    + f""", {_adwin_sql()}, {KSWIN},
ph AS (SELECT source, unnest(s.alarms) AS idx FROM (SELECT source, {_page_hinkley_sql(PH_THRESHOLD_SQL, True)} AS s FROM numbered GROUP BY source)),
votes AS (
  SELECT n.*, a.idx IS NOT NULL AS adwin, k.idx IS NOT NULL AS kswin, p.idx IS NOT NULL AS page_hinkley FROM numbered n
  LEFT JOIN adwin a USING (source, idx) LEFT JOIN kswin k USING (source, idx) LEFT JOIN ph p USING (source, idx))"""
)


@register("kswin_alarms", f"WITH {NUMBERED}, {KSWIN} SELECT source, idx AS message_index FROM kswin")
def kswin_alarms(spark, sf):
    return ops.kswin_alarms(sequence(spark, sf), ORDER, ["source"])


@register("kswin_alarms_shifted", f"WITH {SHIFTED}, {KSWIN} SELECT source, idx AS message_index FROM kswin")
def kswin_alarms_shifted(spark, sf):
    return ops.kswin_alarms(shifted(spark, sf), ORDER, ["source"])


@register("detector_votes", f"WITH RECURSIVE {VOTES} SELECT id, source, idx AS message_index, adwin, kswin, page_hinkley FROM votes")
def detector_votes(spark, sf):
    found = ops.detect(shifted(spark, sf), ORDER, ["source"], settings=QUICK, keep_index=True)
    return found.select("id", "source", "message_index", "adwin", "kswin", "page_hinkley")


#: The whole monitor as one fold over the rows of a source.
MONITOR = (
    VOTES
    + """, scored_votes AS (SELECT *, 0.45e0 * adwin::INT + 0.35e0 * kswin::INT + 0.20e0 * page_hinkley::INT AS composite FROM votes),
folded AS (
  SELECT source, list_reduce(list({'i': idx, 'c': composite, 'on': false, 'sure': false, 'since': 0, 'events': 0,
      'out': CAST([] AS STRUCT(i BIGINT, active BOOLEAN, sure BOOLEAN, edge BOOLEAN, events INTEGER)[])} ORDER BY idx),
    LAMBDA a, e: {'i': e.i, 'c': e.c, 'on': e.c >= 0.5 OR (a.on AND a.since < 1000),
      'sure': CASE WHEN e.c >= 0.5 THEN e.c >= 0.8 ELSE a.sure AND a.since < 1000 END, 'since': CASE WHEN e.c >= 0.5 THEN 0 ELSE a.since + 1 END,
      'events': a.events + CASE WHEN e.c >= 0.5 AND NOT a.on THEN 1 ELSE 0 END,
      'out': list_append(a.out, {'i': e.i, 'active': e.c >= 0.5 OR (a.on AND a.since < 1000),
        'sure': CASE WHEN e.c >= 0.5 THEN e.c >= 0.8 ELSE a.sure AND a.since < 1000 END, 'edge': e.c >= 0.5 AND NOT a.on,
        'events': a.events + CASE WHEN e.c >= 0.5 AND NOT a.on THEN 1 ELSE 0 END})},
    {'i': CAST(0 AS BIGINT), 'c': 0e0, 'on': false, 'sure': false, 'since': 0, 'events': 0,
      'out': CAST([] AS STRUCT(i BIGINT, active BOOLEAN, sure BOOLEAN, edge BOOLEAN, events INTEGER)[])}).out AS out
  FROM scored_votes GROUP BY source),
monitored AS (SELECT source, unnest(out) AS o FROM folded)
SELECT v.id, v.source, v.idx AS message_index, v.adwin, v.kswin, v.page_hinkley, round(v.composite, 4) AS composite_score, o.active AS drift_active,
  o.sure AS drift_confirmed, o.edge AS is_edge, CASE WHEN o.active THEN 5e-5 ELSE 1e-5 END AS recommended_lr,
  round(avg(v.x) OVER (PARTITION BY v.source ORDER BY v.idx ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 4) AS confidence_mean_last100,
  CAST(o.events AS BIGINT) AS total_drift_events
FROM scored_votes v JOIN monitored m ON m.source = v.source AND m.o.i = v.idx"""
)


@register("monitor_by_source", f"WITH RECURSIVE {MONITOR}")
def monitor_by_source(spark, sf):
    """Detectors, composite, hold and counters end to end, one sequence per source."""
    votes = ops.detect(shifted(spark, sf), ORDER, ["source"], settings=QUICK, keep_index=True)
    return drift.drift_state(votes, ORDER, ["source"]).drop("processed_at", "p_fake")
