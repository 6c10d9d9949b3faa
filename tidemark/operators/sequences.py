"""Ordered patterns per key: consecutive repeats, A followed by B, chains of stages.

Order is (event time, sequence number). Every match lies within a bounded time,
so keys are cut into time slices with a halo of that length: one shuffle, no
join, and a hot key spreads over its slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import Span, floor_div, from_micros, micros, span_us
from tidemark.operators.slices import neighbours, slice_width, with_halo

MATCHED, TIMEOUT = "matched", "timeout"


@dataclass(frozen=True)
class Stage:
    name: str
    condition: Column
    strict: bool
    count: int | None = None
    consecutive: bool = False

    def repeats(self) -> list[Stage]:
        if self.count is None:
            return [self]
        return [
            Stage(f"{self.name}_{i + 1}", self.condition, self.strict if i == 0 else self.consecutive)
            for i in range(self.count)
        ]


@dataclass(frozen=True)
class Pattern:
    """Stages to be met in order, e.g.
    ``Pattern.begin("create", is_create).followed_by("pay", is_pay).within("15 minutes")``.

    ``next`` demands the very next row of the key, ``followed_by`` takes the
    first later row that qualifies. Matches may overlap: every begin row counts.
    """

    stages: tuple[Stage, ...]
    span: Span | None = None

    @staticmethod
    def begin(name: str, condition: Column) -> Pattern:
        return Pattern((Stage(name, condition, False),))

    def next(self, name: str, condition: Column) -> Pattern:
        return replace(self, stages=(*self.stages, Stage(name, condition, True)))

    def followed_by(self, name: str, condition: Column) -> Pattern:
        return replace(self, stages=(*self.stages, Stage(name, condition, False)))

    def where(self, condition: Column) -> Pattern:
        """Narrow the latest stage, with all its repeats."""
        last = self.stages[-1]
        return replace(self, stages=(*self.stages[:-1], replace(last, condition=last.condition & condition)))

    def times(self, n: int, consecutive: bool = False) -> Pattern:
        """Repeat the latest stage ``n`` times as ``name_1 … name_n``."""
        if n < 1:
            raise ValueError("times needs n >= 1")
        last = replace(self.stages[-1], count=n, consecutive=consecutive)
        return replace(self, stages=(*self.stages[:-1], last))

    def steps(self) -> list[Stage]:
        """The stages one by one, repeats written out."""
        return [step for stage in self.stages for step in stage.repeats()]

    def within(self, span: Span) -> Pattern:
        return replace(self, span=span)


def match(
    df: DataFrame, keys: Sequence[str], ts: str, seq: str, pattern: Pattern, slice: Span | None = None
) -> DataFrame:
    """One row per begin event that completes the pattern or runs out of time.

    Columns: keys, ``<stage>_ts`` and ``<stage>_seq`` per stage (null for stages
    not reached), ``outcome`` (matched / timeout) and ``at``: time of the last
    stage, or begin plus the allowed time. A match takes strictly less than
    ``within``. A begin whose strict ``next`` fails in time yields nothing.
    """
    if pattern.span is None:
        raise ValueError("close the pattern with within(...)")
    keys = list(keys)
    stages = pattern.steps()
    span = span_us(pattern.span)
    width = slice_width(span, slice)
    kind = df.schema[ts].dataType

    # Condition columns first, so the halo copies carry nothing else of the event.
    hits = {f"_hit{i}": F.coalesce(s.condition, F.lit(False)) for i, s in enumerate(stages)}
    rows = df.select(*keys, micros(df, ts).alias("_us"), F.col(seq).alias("_seq"), *[c.alias(n) for n, c in hits.items()])
    if not any(s.strict for s in stages):
        wanted = F.lit(False)
        for name in hits:
            wanted = wanted | F.col(name)
        rows = rows.where(wanted)
    rows = with_halo(rows, "_us", width, ahead=span)

    # Walk backwards in time, so "the first later row" is the latest one seen so far.
    backwards = Window.partitionBy(*keys, "_slice").orderBy(F.desc("_us"), F.desc("_seq"))
    seen = backwards.rowsBetween(Window.unboundedPreceding, -1)
    for i in range(len(stages) - 1, 0, -1):
        fields = [F.col(f"_hit{i}").alias("hit"), F.col("_us").alias("us"), F.col("_seq").alias("seq")]
        if i + 1 < len(stages):
            fields.append(F.col(f"_later{i + 1}").alias("rest"))
        here = F.struct(*fields)
        if stages[i].strict:
            later = F.lag(here).over(backwards)
        else:
            later = F.last(F.when(F.col(f"_hit{i}"), here), ignorenulls=True).over(seen)
        rows = rows.withColumn(f"_later{i}", later)
    begins = rows.where(F.col("_own") & F.col("_hit0"))

    # Follow the chain from the begin row; a stage is reached if it and all before it are in time.
    stage_columns = [
        from_micros(F.col("_us"), kind).alias(f"{stages[0].name}_ts"),
        F.col("_seq").alias(f"{stages[0].name}_seq"),
    ]
    reached, broken, at = F.lit(True), F.lit(False), F.col("_us")
    link = "_later1"
    for i in range(1, len(stages)):
        node = F.col(link)
        in_time = reached & node.isNotNull() & (node["us"] - F.col("_us") < span)
        broken = broken | F.coalesce(in_time & ~node["hit"], F.lit(False))
        reached = F.coalesce(in_time & node["hit"], F.lit(False))
        stage_columns += [
            F.when(reached, from_micros(node["us"], kind)).alias(f"{stages[i].name}_ts"),
            F.when(reached, node["seq"]).alias(f"{stages[i].name}_seq"),
        ]
        at = node["us"]
        link = f"{link}.rest"
    outcome = F.when(reached, MATCHED).when(~broken, TIMEOUT)
    end = F.when(reached, at).otherwise(F.col("_us") + span)
    return begins.select(
        *keys, *stage_columns, outcome.alias("outcome"), from_micros(end, kind).alias("at")
    ).where(F.col("outcome").isNotNull())


def consecutive_hits(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    condition: Column,
    n: int,
    within: Span,
    inclusive: bool = False,
    slice: Span | None = None,
) -> DataFrame:
    """Every ``n`` rows of a key that follow each other directly, all meet ``condition``
    and span less than ``within`` (at most ``within`` if ``inclusive``)."""
    keys = list(keys)
    span = span_us(within)
    kind = df.schema[ts].dataType
    rows = df.select(
        *keys, micros(df, ts).alias("_us"), F.col(seq).alias("_seq"), F.coalesce(condition, F.lit(False)).alias("_hit")
    )
    rows = with_halo(rows, "_us", slice_width(span, slice), back=span)
    order = Window.partitionBy(*keys, "_slice").orderBy("_us", "_seq")
    first = F.lag(F.struct("_us", "_seq"), n - 1).over(order) if n > 1 else F.struct("_us", "_seq")
    all_hit = F.min("_hit").over(order.rowsBetween(-(n - 1), 0))
    gap = F.col("_us") - F.col("_first._us")
    found = rows.withColumns({"_first": first, "_all": all_hit}).where(
        F.col("_own") & F.col("_all") & ((gap <= span) if inclusive else (gap < span))
    )
    return found.select(
        *keys,
        from_micros(F.col("_first._us"), kind).alias("first_ts"),
        from_micros(F.col("_us"), kind).alias("last_ts"),
        F.col("_first._seq").alias("first_seq"),
        F.col("_seq").alias("last_seq"),
    )


def adjacent_pairs_by_arrival(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    condition: Column,
    within: Span,
    chunk_rows: int = 5_000_000,
) -> DataFrame:
    """Pairs of rows adjacent in arrival order (``seq``) that both meet ``condition``
    and whose event times differ by at most ``within``; a step back in time counts."""
    keys = list(keys)
    kind = df.schema[ts].dataType
    rows = df.select(
        *keys,
        micros(df, ts).alias("_us"),
        F.col(seq).alias("_seq"),
        F.coalesce(condition, F.lit(False)).alias("_hit"),
        floor_div(F.col(seq).cast("bigint"), chunk_rows).alias("_slice"),
    )
    placed = neighbours(rows, keys, "_slice", ["_seq"], F.struct("_us", "_seq", "_hit"))
    return placed.where(
        F.col("_hit") & F.col("_prev._hit") & (F.col("_us") - F.col("_prev._us") <= span_us(within))
    ).select(
        *keys,
        from_micros(F.col("_prev._us"), kind).alias("first_ts"),
        from_micros(F.col("_us"), kind).alias("last_ts"),
        F.col("_prev._seq").alias("first_seq"),
        F.col("_seq").alias("last_seq"),
    )


def open_close_outcomes(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    opens: Column,
    closes: Column,
    within: Span,
    slice: Span | None = None,
) -> DataFrame:
    """One outcome per opening event, and one per closing event that nothing opened.

    An opening directly followed by a closing is ``paid`` (gap below ``within``)
    or ``paid_late``, whatever the gap; otherwise it is a ``timeout``. A closing
    not directly preceded by an opening is an ``orphan_pay``. At equal times
    openings come first. A row that meets both conditions is an opening; an unknown
    condition is not met; rows without a time take no part.
    """
    keys = list(keys)
    span = span_us(within)
    kind = df.schema[ts].dataType
    opens, closes = (F.coalesce(c, F.lit(False)) for c in (opens, closes))
    rows = df.where((opens | closes) & F.col(ts).isNotNull()).select(
        *keys, micros(df, ts).alias("_us"), (~opens).cast("int").alias("_close"), F.col(seq).alias("_seq")
    )
    rows = rows.withColumn("_slice", floor_div(F.col("_us"), slice_width(span, slice)))
    placed = neighbours(rows, keys, "_slice", ["_us", "_close", "_seq"], F.struct("_us", "_close", "_seq"))
    is_open, paid = F.col("_close") == 0, F.col("_next._close") == 1
    in_time = F.col("_next._us") - F.col("_us") < span
    outcome = (
        F.when(is_open & paid & in_time, "paid")
        .when(is_open & paid, "paid_late")
        .when(is_open, TIMEOUT)
        .when(F.coalesce(F.col("_prev._close"), F.lit(1)) == 1, "orphan_pay")
    )
    settled = F.col("outcome").isin("paid", "paid_late")
    at = F.when(settled, F.col("_next._us")).when(is_open, F.col("_us") + span).otherwise(F.col("_us"))
    return (
        placed.withColumn("outcome", outcome)
        .where(F.col("outcome").isNotNull())
        .select(
            *keys,
            "outcome",
            F.when(is_open, from_micros(F.col("_us"), kind)).alias("open_ts"),
            F.when(is_open, F.col("_seq")).alias("open_seq"),
            F.when(settled, from_micros(F.col("_next._us"), kind))
            .when(~is_open, from_micros(F.col("_us"), kind))
            .alias("close_ts"),
            F.when(settled, F.col("_next._seq")).when(~is_open, F.col("_seq")).alias("close_seq"),
            from_micros(at, kind).alias("at"),
        )
    )
