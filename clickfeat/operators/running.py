"""Point-in-time running counts that do not gather a hot key into one task.

A running ``COUNT(*) OVER (PARTITION BY k ORDER BY t)`` with the default
RANGE frame counts every row of ``k`` with time <= t, peers included. Planned
directly as a window, all rows of one key go to one task: a session holding
a third of all events would be sorted by a single core.

Here the time axis is cut into slices: days, and for a (key, day) group of
more than ``hot_rows`` events minutes, and for a (key, minute) group of as
many single instants. One plan serves every size. The hot groups come from a
small aggregate inside the plan; a group is hot above ``hot_rows`` or above
the ``most_hot``-th part of all rows, whichever is more, so there are at most
``most_hot`` of them and they can be broadcast:

1. Slice totals per (k, slice) -- an aggregate, combined map-side -- are
   summed over earlier slices with a window partitioned by k whose rows are
   slices (bounded by the key's time span). That gives each (k, slice) an
   offset: the key's counts before the slice.
2. Each non-zero offset becomes one extra row of its (k, slice), with a
   NULL time so it sorts before the slice's events. Events and offset rows
   are unioned and exchanged once, by (first level's k, slice). A row carries
   each key once, and one set of four offsets with the level they belong to.
3. Every level's running count is then a window sum over (k, slice) only:
   the offset row plus the events up to the current time. Levels whose keys
   extend the first (session -> session x product) use the same exchange,
   as do the tie counts and the label.

A task thus holds one slice of a key, never the whole key, whatever the
key's share of all rows: a slice has at most about ``hot_rows`` events or is
one instant, whose events are all peers.

NULL key values form their own group, as in a window partition: grouping
uses a non-null stand-in plus an is-null flag per key. A key a row does not
carry (the product of a session-level offset row) is NULL in both, which no
event has, so such rows never enter another level's partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.ratios import COUNTS, RATIOS, TYPED_COUNTS
from clickfeat.functions.sqlexpr import as_, cols, null_of, project, q, ratio, zero_of

SLICE = "_slice"
_LEVEL = "_level"


def group_cols(keys: Sequence[str]) -> list[str]:
    return [c for k in keys for c in (f"_g_{k}", f"_z_{k}")]


def _flag_sql(count: str, type_col: str) -> str:
    """0/1 weight of an event for ``count`` (events: always 1)."""
    if count == "events":
        return "CAST(1 AS BIGINT)"
    value = dict(TYPED_COUNTS)[count]
    return f"CAST(CASE WHEN {q(type_col)} = '{value}' THEN 1 ELSE 0 END AS BIGINT)"


def slice_totals(sliced: DataFrame, keys: Sequence[str], type_col: str = "event_type") -> DataFrame:
    """Per (key, slice): events and typed counts (combined map-side)."""
    return sliced.groupBy(*group_cols(keys), SLICE).agg(
        *[F.expr(f"SUM({_flag_sql(c, type_col)}) AS {q(c)}") for c in COUNTS])


def rollup_totals(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slice totals of a coarser key, summed from a finer key's totals."""
    return totals.groupBy(*group_cols(keys), SLICE).agg(
        *[F.expr(f"SUM({q(c)}) AS {q(c)}") for c in COUNTS])


def slice_offsets(totals: DataFrame, keys: Sequence[str], prefix: str,
                  outcome: bool = False) -> DataFrame:
    """Counts of the key's earlier slices (exclusive prefix over slices).

    With ``outcome``, also ``purchased``: 1 if any slice of the key has a
    purchase -- same window partition, no extra shuffle.
    """
    part = ", ".join(cols(group_cols(keys)))
    w = f"OVER (PARTITION BY {part} ORDER BY {q(SLICE)})"
    exprs = [*cols(group_cols(keys)), q(SLICE),
             *[as_(f"SUM({q(c)}) {w} - {q(c)}", f"{prefix}_off_{c}") for c in COUNTS]]
    if outcome:
        exprs.append(as_(f"MAX(CASE WHEN purchases > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {part})",
                         "purchased"))
    return project(totals, exprs)


def level_columns(name: str) -> list[str]:
    return [f"{name}__{m}" for m in (*COUNTS, *(r[0] for r in RATIOS))]


@dataclass(frozen=True)
class Slicing:
    """How the time axis of a key is cut: ``unit`` buckets; groups of a
    first-level key and bucket with more than ``hot_rows`` events by the next
    of ``finer``, and so on ("instant": by the event time itself)."""

    unit: str = "day"
    finer: tuple[str, ...] = ("minute", "instant")
    hot_rows: int = 2_000_000
    most_hot: int = 50_000  # some 5 MB of (key, slice) rows to broadcast


SLICING = Slicing()


def add_slices(events: DataFrame, keys: Sequence[str], time_col: str,
               slicing: Slicing = SLICING) -> DataFrame:
    """Attach ``_slice``: ``slicing.unit`` buckets, cut finer where (key, bucket) is hot."""
    t, gk = q(time_col), group_cols(keys)

    def bucket(unit: str) -> str:
        return t if unit == "instant" else f"date_trunc('{unit}', {t})"

    out = events.selectExpr("*", as_(bucket(slicing.unit), SLICE))
    for unit in slicing.finer:
        sizes = out.groupBy(*gk, SLICE).count()
        share = sizes.agg(F.sum("count")).scalar() / slicing.most_hot
        hot = sizes.filter(F.col("count") > F.greatest(F.lit(float(slicing.hot_rows)), F.coalesce(share, F.lit(0.0))))
        # At most most_hot groups can each hold more than that share of all rows.
        marked = out.join(F.broadcast(hot.selectExpr(*cols([*gk, SLICE]), "true AS _hot")), on=[*gk, SLICE], how="left")
        out = marked.selectExpr(*cols(events.columns), as_(f"CASE WHEN _hot THEN {bucket(unit)} ELSE {q(SLICE)} END", SLICE))
    return out


def with_running(events: DataFrame, levels: Mapping[str, Sequence[str]],
                 time_col: str = "event_time", slicing: Slicing = SLICING,
                 outcome_level: str | None = None,
                 type_col: str = "event_type") -> DataFrame:
    """Append, for each level ``name -> keys``, its running metrics at every event.

    Levels must nest: each level's keys extend the first level's keys, and
    ``time_col`` must be non-NULL (as in silver). Added per level:
    ``<name>__<metric>`` for the ten metrics and ``_ties__<name>`` (events
    sharing the level key and instant). With ``outcome_level`` (the finest
    level), also ``purchased``: 1 if that key has any purchase at any time.
    """
    names = list(levels)
    coarse = list(levels[names[0]])
    finest = max(names, key=lambda n: len(levels[n]))
    for n in names:
        if list(levels[n][:len(coarse)]) != coarse:
            raise ValueError("levels must extend the first level's keys")
    if outcome_level not in (None, finest):
        raise ValueError("the outcome is taken at the finest level")
    all_keys = list(dict.fromkeys(k for n in names for k in levels[n]))
    types = {f.name: f.dataType for f in events.schema.fields}
    event_cols = [f.name for f in events.schema.fields]
    other = [c for c in event_cols if c not in all_keys]

    stand_ins = []
    for k in all_keys:
        stand_ins += [as_(f"coalesce({q(k)}, {zero_of(types[k])})", f"_g_{k}"),
                      as_(f"({q(k)} IS NULL)", f"_z_{k}")]
    sliced = add_slices(events.selectExpr(*cols(other), *stand_ins), coarse, time_col, slicing)

    # Offsets: the events are aggregated once, at the finest level; coarser
    # levels roll those totals up (small tables, one row per key and slice).
    fine_totals = slice_totals(sliced, levels[finest], type_col)
    offsets = {}
    for n in names:
        totals = fine_totals if n == finest else rollup_totals(fine_totals, levels[n])
        offsets[n] = slice_offsets(totals, levels[n], n, outcome=n == outcome_level)

    # One row layout for events (no level) and offset rows.
    rows = project(sliced, [
        *cols(other), *cols(group_cols(all_keys)), q(SLICE), as_("CAST(NULL AS INT)", _LEVEL),
        *[as_("CAST(NULL AS BIGINT)", f"_off_{c}") for c in COUNTS], "CAST(NULL AS INT) AS purchased"])
    for i, n in enumerate(names):
        own = set(group_cols(levels[n]))
        # A key's first slice has nothing before it: no row needed, unless
        # it carries the key's label.
        needed = f"{q(n + '_off_events')} > 0"
        if n == outcome_level:
            needed += " OR purchased = 1"
        layout = [
            *[as_(null_of(types[c]), c) for c in other],
            *[q(c) if c in own else f"CAST(NULL AS {'boolean' if c.startswith('_z_') else types[c[3:]].simpleString()}) AS {q(c)}"
              for c in group_cols(all_keys)],
            q(SLICE), as_(str(i), _LEVEL), *[as_(q(f"{n}_off_{c}"), f"_off_{c}") for c in COUNTS],
            "purchased" if n == outcome_level else "CAST(NULL AS INT) AS purchased",
        ]
        rows = rows.unionByName(project(offsets[n].filter(needed), layout))

    # The one exchange: by (first level's key, slice). Every window below
    # partitions by a superset of it, so none adds another. Per level, the
    # running sums and the tie count share one sort (key, slice, time); the
    # label window is satisfied by the finest one.
    rows = rows.repartition(*group_cols(coarse), SLICE)
    t = q(time_col)
    for n in sorted(names, key=lambda n: len(levels[n])):
        part = ", ".join(cols([*group_cols(levels[n]), SLICE]))
        w = f"OVER (PARTITION BY {part} ORDER BY {t} ASC NULLS FIRST)"
        weight = (f"CASE WHEN {_LEVEL} IS NULL THEN {{flag}} WHEN {_LEVEL} = {names.index(n)} THEN {{off}} "
                  "ELSE CAST(0 AS BIGINT) END")
        rows = rows.selectExpr("*", *[
            as_(f"SUM({weight.format(flag=_flag_sql(c, type_col), off=q(f'_off_{c}'))}) {w}", f"{n}__{c}")
            for c in COUNTS])
        rows = rows.selectExpr("*", as_(f"COUNT(CASE WHEN {_LEVEL} IS NULL THEN 1 END) OVER (PARTITION BY {part}, {t})",
                                        f"_ties__{n}"))

    out = [as_(f"CASE WHEN NOT {q(f'_z_{c}')} THEN {q(f'_g_{c}')} END", c) if c in all_keys else q(c) for c in event_cols]
    for n in names:
        out += [*cols(f"{n}__{c}" for c in COUNTS),
                *[as_(ratio(f"{n}__{a}", f"{n}__{b}"), f"{n}__{r}") for r, a, b in RATIOS],
                q(f"_ties__{n}")]
    if outcome_level is not None:
        # Before the filter: the label rides on the offset rows.
        part = ", ".join(cols([*group_cols(levels[outcome_level]), SLICE]))
        rows = rows.selectExpr(
            *[q(c) for c in rows.columns if c != "purchased"],
            as_(f"coalesce(MAX(purchased) OVER (PARTITION BY {part}), 0)", "purchased"))
        out.append("purchased")
    return rows.filter(f"{_LEVEL} IS NULL").selectExpr(*out)
