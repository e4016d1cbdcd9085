"""Point-in-time exponentially decayed counters with visibility delays.

For a target at time t, a key set and a gap, a counter holds

    sum over matching events e of the key with t_e <= t - gap of
        x_e * exp(-(t_last - t_e) / tau),      t_last = the last such t_e

so the value stands as of the last visible event, not of the read. With a common
origin o this is  S * exp(-(t_last - o) / tau),  S = sum x_e * exp((t_e - o) / tau):
a running sum and a running maximum, which one window pass yields.

Over a span of many decay times those weights overflow. Time is then cut into anchor blocks of ``ANCHOR`` decay times,
sums start anew in each, and a carry row brings in the state (last time, value) that the earlier blocks leave, rescaled.

Plan: events and reads (one read per target, key set and gap) go through one
shuffle on (key, block); all key sets, gaps and counters share it. Reads then
meet per target in a second, narrow shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import SECOND, gap_label, gap_micros, micros
from tidemark.operators.hotkeys import BEFORE_ALL, BLOCK, Blocked, HotKeys, split_hot_keys

# Visibility delays and decay time of the standard counters.
STANDARD_GAPS = (timedelta(minutes=1), timedelta(hours=1), timedelta(days=1))
STANDARD_TAU = timedelta(days=30)
LONG_VIEW_MS = 90_000

MAX_EXPONENT = 600.0  # exp() stays finite, with room for the sum
ANCHOR = 300  # decay times of an anchor block; what lies three blocks back weighs less than exp(-600)


@dataclass(frozen=True)
class Counter:
    """Adds ``value`` (a SQL expression over the event's columns) at every event named ``event``."""

    name: str
    event: str
    value: str
    tau: timedelta = STANDARD_TAU


def livestream_counters(tau: timedelta = STANDARD_TAU) -> list[Counter]:
    """The seven standard counters over live-stream events."""
    long_view = f"CASE WHEN duration_ms > {LONG_VIEW_MS} THEN 1.0 ELSE 0.0 END"
    suffix = gap_label(tau)
    return [
        Counter(f"timespent_decay_{suffix}", "view_end", "duration_ms", tau),
        Counter(f"lives_count_{suffix}", "view_end", long_view, tau),
        Counter(f"like_count_{suffix}", "like", "like_counter", tau),
        Counter(f"gift_count_{suffix}", "gift", "gift_quantity", tau),
        Counter(f"gift_value_{suffix}", "gift", "gift_cheers_value * gift_quantity", tau),
        Counter(f"shares_{suffix}", "share", "1.0", tau),
        Counter(f"comments_{suffix}", "comment", "1.0", tau),
    ]


def quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def feature_name(keys: Sequence[str], gap: timedelta, counter: str, prefix: str = "feature_") -> str:
    return f"{prefix}{'_'.join(keys)}_{gap_label(gap)}_{counter}"


def _key_rows(key_sets: Sequence[Sequence[str]], width: int, whole: bool = False) -> str:
    """SQL for one struct per key set; keys stay separate columns, never a joined string.

    ``whole`` leaves out key sets that hold a null.
    """
    rows = []
    for i, keys in enumerate(key_sets):
        padded = [f"CAST(`{k}` AS STRING)" for k in keys] + ["CAST(NULL AS STRING)"] * (width - len(keys))
        fields = ", ".join(f"{col} AS _k{j}" for j, col in enumerate(padded))
        row = f"struct({i} AS _set, {fields})"
        known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys) or "true"
        rows.append(f"CASE WHEN {known} THEN {row} END" if whole else row)
    if whole:
        return f"explode(array_compact(array({', '.join(rows)}))) AS _key"
    return f"explode(array({', '.join(rows)})) AS _key"


def decayed_counters(
    events: DataFrame,
    targets: DataFrame,
    *,
    key_sets: Sequence[Sequence[str]],
    counters: Sequence[Counter],
    gaps: Sequence[timedelta] = STANDARD_GAPS,
    time: str = "event_time",
    event_name: str = "event_name",
    target_id: str = "event_id",
    start: datetime | None = None,
    decay_to_read: bool = False,
    whole_seconds: bool = False,
    prefix: str = "feature_",
    policy: HotKeys = HotKeys(),
) -> DataFrame:
    """``targets`` plus one DOUBLE column per key set, gap and counter (0 where nothing is visible).

    ``target_id`` must identify a target row; a target without one gets null features. Targets never feed
    counters, nor do events whose key is null. ``start`` drops earlier targets. ``decay_to_read`` decays on to
    the target's time; ``whole_seconds`` truncates event times for the decay only.
    """
    width = max(len(keys) for keys in key_sets)
    key_cols = ["_set"] + [f"_k{j}" for j in range(width)]
    names = list(dict.fromkeys(c.event for c in counters))
    if start is not None:
        targets = targets.where(F.col(time) >= F.lit(start))

    fed = (
        events.where(F.col(event_name).isin(names))
        .withColumns({"_us": micros(time), "_event": F.col(event_name)})
        .selectExpr(
            "_us",
            "_event",
            *[
                f"CASE WHEN _event = {quoted(c.event)} THEN coalesce(CAST({c.value} AS DOUBLE), 0D) END AS _x{i}"
                for i, c in enumerate(counters)
            ],
            _key_rows(key_sets, width, whole=True),
        )
    )
    delays = ", ".join(f"{gap_micros(g)}L" for g in gaps)
    reads = (
        targets.withColumns({"_target": F.col(target_id), "_at": micros(time)})
        .selectExpr("_target", "_at", _key_rows(key_sets, width))
        .selectExpr("_target", "_at", "_key", f"posexplode(array({delays})) AS (_gap, _delay)")
        .selectExpr("_target", "_gap", "_key", "_at - _delay AS _us")
    )
    rows = fed.unionByName(reads, allowMissingColumns=True).select("*", "_key.*").drop("_key")

    blocked = split_hot_keys(rows, key_cols, "_us", policy)
    span = blocked.latest - blocked.origin
    short = [i for i, c in enumerate(counters) if span <= MAX_EXPONENT * gap_micros(c.tau)]
    by_tau = {c.tau: [i for i, x in enumerate(counters) if x.tau == c.tau] for i, c in enumerate(counters) if i not in short}
    state: DataFrame | None = None
    for tau, members in ((None, short), *by_tau.items()):
        if not members:
            continue
        chosen = {i: counters[i] for i in members}
        if tau is None:
            part = _common_origin(blocked, key_cols, chosen, delays, decay_to_read, whole_seconds)
        else:
            part = _anchored(blocked, key_cols, chosen, delays, decay_to_read, whole_seconds)
        state = part if state is None else state.unionByName(part, allowMissingColumns=True)
    cells = [
        f"coalesce(max(CASE WHEN _set = {s} AND _gap = {g} THEN _v{i} END), 0D)"
        f" AS `{feature_name(keys, gap, c.name, prefix)}`"
        for s, keys in enumerate(key_sets)
        for g, gap in enumerate(gaps)
        for i, c in enumerate(counters)
    ]
    features = state.withColumnRenamed("_target", target_id).groupBy(target_id).agg(*map(F.expr, cells))
    return targets.join(features, target_id, "left")


def _weighed(rows: DataFrame, start: str, counters: Mapping[int, Counter], names: Sequence[str], whole_seconds: bool) -> DataFrame:
    """Events weighted from ``start`` (``_s``) and their times per event name (``_l``)."""
    felt = f"(_us - pmod(_us, {SECOND}))" if whole_seconds else "_us"
    return rows.selectExpr(
        *[c for c in rows.columns if not c.startswith("_x") and c != "_event"],
        *[f"_x{i} * exp(({felt} - {start}) / {gap_micros(c.tau)}D) AS _s{i}" for i, c in counters.items()],
        *[f"CASE WHEN _event = {quoted(name)} THEN {felt} END AS _l{j}" for j, name in enumerate(names)],
    )


def _common_origin(
    blocked: Blocked, key_cols: list[str], counters: Mapping[int, Counter], delays: str, decay_to_read: bool, whole_seconds: bool
) -> DataFrame:
    """(_target, _set, _gap, _v) of counters whose weights stay finite over the whole span."""
    names = list(dict.fromkeys(c.event for c in counters.values()))
    origin = f"{blocked.origin}L"

    def weighed(part: DataFrame) -> DataFrame:
        return _weighed(part, origin, counters, names, whole_seconds)

    carried = blocked.hot and _carry(weighed(blocked.hot), key_cols, list(counters), len(names))
    so_far = f"OVER (PARTITION BY {', '.join(key_cols)}, {BLOCK} ORDER BY _us)"  # up to and including ties
    state = (
        replace(blocked, rows=weighed(blocked.rows))
        .with_carry(carried)
        .selectExpr(
            "_target",
            "_set",
            "_gap",
            "_us",
            *[f"sum(_s{i}) {so_far} AS _s{i}" for i in counters],
            *[f"max(_l{j}) {so_far} AS _l{j}" for j in range(len(names))],
        )
        .where("_target IS NOT NULL")
    )
    values = []
    for i, c in counters.items():
        as_of = f"(_us + array({delays})[_gap])" if decay_to_read else f"_l{names.index(c.event)}"
        values.append(f"_s{i} * exp(({origin} - {as_of}) / {gap_micros(c.tau)}D) AS _v{i}")
    return state.selectExpr("_target", "_set", "_gap", *values)


def _carry(hot: DataFrame, key_cols: list[str], sums_of: list[int], n_lasts: int) -> DataFrame:
    """One row per block of a hot key with the state its earlier blocks leave behind."""
    earlier = (
        f"OVER (PARTITION BY {', '.join(key_cols)} ORDER BY {BLOCK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    sums = [("sum", f"_s{i}") for i in sums_of]
    lasts = [("max", f"_l{j}") for j in range(n_lasts)]
    per_block = hot.groupBy(*key_cols, BLOCK).agg(*[F.expr(f"{fn}({c}) AS {c}") for fn, c in sums + lasts])
    return per_block.selectExpr(
        *key_cols,
        BLOCK,
        f"{BEFORE_ALL} AS _us",
        *[f"{fn}({c}) {earlier} AS {c}" for fn, c in sums + lasts],
    )


def _anchored(
    blocked: Blocked, key_cols: list[str], counters: Mapping[int, Counter], delays: str, decay_to_read: bool, whole_seconds: bool
) -> DataFrame:
    """(_target, _set, _gap, _v) of counters of one decay time, over any span.

    A cell is a key's rows of one time block and one anchor block; cells of a key are in order of time. The value at a cell's
    last event adds the sums of its own anchor block and of the two before, each rescaled from its own start. A
    cell starts with the last such value before it. Cells are at most as many as rows; a key's cells, but not its rows, pass
    through one task, as they stream by.
    """
    tau = gap_micros(next(iter(counters.values())).tau)
    names = list(dict.fromkeys(c.event for c in counters.values()))
    event = {i: names.index(c.event) for i, c in counters.items()}
    keys, start = ", ".join(key_cols), f"({blocked.origin}L + _a * {ANCHOR * tau}L)"
    timed = blocked.rows.withColumn("_a", F.expr(f"(_us - {blocked.origin}L) DIV {ANCHOR * tau}L"))
    weighed = _weighed(timed, start, counters, names, whole_seconds)

    cells = weighed.groupBy(*key_cols, BLOCK, "_a").agg(
        *[F.expr(f"sum(_s{i}) AS _s{i}") for i in counters], *[F.expr(f"max(_l{j}) AS _l{j}") for j in range(len(names))]
    )

    def at_end(i: int) -> str:
        own = f"sum(_s{i}) OVER (PARTITION BY {keys}, _a ORDER BY {BLOCK} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        back = [
            f"coalesce(sum(_s{i}) OVER (PARTITION BY {keys} ORDER BY _a RANGE BETWEEN {d} PRECEDING AND {d} PRECEDING), 0D)"
            f" * exp({-d * ANCHOR}D)"
            for d in (1, 2)
        ]
        return f"CASE WHEN _l{event[i]} IS NOT NULL THEN ({' + '.join([own, *back])}) * exp(({start} - _l{event[i]}) / {tau}D) END AS _v{i}"

    ends = cells.selectExpr(*key_cols, BLOCK, "_a", *map(at_end, counters), *[f"_l{j}" for j in range(len(names))])
    before = f"OVER (PARTITION BY {keys} ORDER BY {BLOCK}, _a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = ends.selectExpr(
        *key_cols,
        BLOCK,
        "_a",
        f"{BEFORE_ALL} AS _us",
        *[f"last(_v{i}, true) {before} AS _v{i}" for i in counters],
        *[f"last(_l{j}, true) {before} AS _c{j}" for j in range(len(names))],
    )
    so_far = f"OVER (PARTITION BY {keys}, {BLOCK}, _a ORDER BY _us)"  # up to and including ties
    state = (
        weighed.unionByName(carried, allowMissingColumns=True)
        .selectExpr(
            "_target",
            "_set",
            "_gap",
            "_us",
            "_a",
            *[f"sum(_s{i}) {so_far} AS _s{i}" for i in counters],
            *[f"max(_v{i}) {so_far} AS _v{i}" for i in counters],
            *[f"max(_{x}{j}) {so_far} AS _{x}{j}" for j in range(len(names)) for x in "lc"],
        )
        .where("_target IS NOT NULL")
    )
    values = []
    for i, j in event.items():
        after = f"_s{i} * exp(({start} - _l{j}) / {tau}D) + coalesce(_v{i} * exp((_c{j} - _l{j}) / {tau}D), 0D)"
        to_read = f" * exp((coalesce(_l{j}, _c{j}) - (_us + array({delays})[_gap])) / {tau}D)" if decay_to_read else ""
        values.append(f"(CASE WHEN _l{j} IS NULL THEN _v{i} ELSE {after} END){to_read} AS _v{i}")
    return state.selectExpr("_target", "_set", "_gap", *values)
