"""Exact quantiles of whole columns with bounded state per task.

The wanted ranks are bracketed by approximate pivots, counted exactly, and the brackets
narrowed until each holds few rows, whose value at the rank is then taken as it is. Every
round is one scan with a map-side aggregate: no row is shuffled and none is dropped. A small
column starts as a bracket of few rows. Ranks are interpolated by one formula at every size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyrow.functions.text import named

# Rows of a bracket that one exact aggregate settles.
BRACKET_ROWS = 1_000_000
_ACCURACY = 10_000


@dataclass
class _Rank:
    """The rank-th smallest value (from 0) lies in (low, high), below rows precede it."""

    column: str
    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def within(self) -> Column:
        v = _number(self.column)
        held = v.isNotNull()
        if self.low is not None:
            held = held & (v > self.low)
        if self.high is not None:
            held = held & (v < self.high)
        return held


def _number(column: str) -> Column:
    v = named(column).cast("double")
    return F.when(~F.isnan(v), v)


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    counts: dict[str, int] | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles per column; None for a column without values.

    ``counts`` (non-null rows per column) saves the first pass when known.
    """
    if not columns:
        return {}
    narrow = df.select(*[named(c) for c in columns])
    if counts is None:
        row = narrow.agg(*[F.count(_number(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    result: dict[str, list[float] | None] = {c: None for c in columns}
    filled = [c for c in columns if counts[c]]
    if not filled:
        return result
    wanted = {
        (c, k)
        for c in filled
        for p in probabilities
        for k in (math.floor(p * (counts[c] - 1)), math.ceil(p * (counts[c] - 1)))
    }
    found = _resolve(narrow, [_Rank(c, k, 0, counts[c]) for c, k in sorted(wanted)], bracket_rows)
    for c in filled:
        result[c] = [_between(found, c, p * (counts[c] - 1)) for p in probabilities]
    return result


def _between(found: dict[tuple[str, int], float], column: str, at: float) -> float:
    low, high = math.floor(at), math.ceil(at)
    if low == high:
        return found[(column, low)]
    return (high - at) * found[(column, low)] + (at - low) * found[(column, high)]


def _resolve(df: DataFrame, ranks: list[_Rank], bracket_rows: int) -> dict[tuple[str, int], float]:
    open_ranks = ranks
    while open_ranks:
        few = [r for r in open_ranks if r.inside <= bracket_rows]
        many = [r for r in open_ranks if r.inside > bracket_rows]
        held = df.select(
            *[F.when(r.within(), _number(r.column)).alias(f"e{i}") for i, r in enumerate(few)],
            *[F.when(r.within(), _number(r.column)).alias(f"a{i}") for i, r in enumerate(many)],
        )
        row = held.agg(
            *[F.expr(_element(r, f"e{i}")).alias(f"e{i}") for i, r in enumerate(few)],
            *[F.percentile_approx(f"a{i}", _around(r), F.lit(_ACCURACY)).alias(f"a{i}") for i, r in enumerate(many)],
        ).first()
        for i, r in enumerate(few):
            r.value = row[f"e{i}"]
        pivots = {i: sorted(set(row[f"a{i}"])) for i in range(len(many))}
        if many:
            tallies = []
            for i, r in enumerate(many):
                v = _number(r.column)
                for j, pivot in enumerate(pivots[i]):
                    tallies.append(F.count_if(v < pivot).alias(f"l{i}_{j}"))
                    tallies.append(F.count_if(v <= pivot).alias(f"u{i}_{j}"))
            row = df.agg(*tallies).first()
            for i, r in enumerate(many):
                _narrow(r, [(p, row[f"l{i}_{j}"], row[f"u{i}_{j}"]) for j, p in enumerate(pivots[i])])
        open_ranks = [r for r in many if r.value is None]
    return {(r.column, r.rank): r.value for r in ranks}


def _element(r: _Rank, name: str) -> str:
    """The value of this rank itself: half a row below its cumulative share."""
    share = (r.rank - r.below + 0.5) / r.inside
    return f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY {name})"


def _around(r: _Rank) -> Column:
    share = (r.rank - r.below + 0.5) / r.inside
    step = 2.0 / _ACCURACY
    return F.array(*[F.lit(min(max(share + d, 0.0), 1.0)) for d in (-step, 0.0, step)])


def _narrow(r: _Rank, pivots: list[tuple[float, int, int]]) -> None:
    above = r.below + r.inside
    for pivot, less, up_to in pivots:
        if less <= r.rank < up_to:
            r.value = pivot
            return
        if up_to <= r.rank:
            r.low, r.below = pivot, up_to
        elif less > r.rank:
            r.high, above = pivot, less
            break
    r.inside = above - r.below
