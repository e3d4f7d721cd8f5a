"""Rolling features over a key's time series.

A feature at time ``t`` covers ``[t - seconds, t]``, both ends included, so rows of
the same second see each other. Rows without a time form a group of their own.

Two equivalent plans:

* ``rolling_windows`` - range windows; one shuffle and one sort for all features.
  A key is one window group, and the cost of a frame grows with its rows, so it
  suits keys of ordinary size.
* ``rolling_sliced`` - for keys of any size. Rows are first reduced to one per
  (key, second). Whole numbers (counts, money, distinct values as comings and goings)
  then get running totals since the key's first second, from totals of days and running
  sums within a day; a frame is the total at its end less the total before its start.
  One pass serves all frame lengths. Other doubles would lose digits in a difference:
  for them a frame is the sum of a suffix of one slice and a prefix of the next, a pass
  per length. Either way cost is linear in the rows, and no group holds more than the
  seconds of two slices, or a key's days, however many rows the key has.

``rolling_features`` sends keys with crowded frames to the second plan. Counts and
distinct counts agree exactly, and so do sums, means and deviations of money (``digits``),
which add whole units. Of other doubles, NaN and infinity count only in the frames that
hold them, 0.0 equals -0.0, and sums may differ in their last bits between the plans.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.cleaning import epoch_seconds
from ledgerlens.functions.measures import MONEY_DIGITS, units
from ledgerlens.session import cut_lineage

_SEC = "_sec"
_WHO = "_who"
_CROWDED = "_crowded_key"
_STRETCH = 8
_NO_TIME = -(1 << 60)  # stands for a missing time; no frame of a real time reaches it


@dataclass(frozen=True)
class Rolling:
    name: str
    agg: Literal["count", "sum", "avg", "std", "distinct"]
    column: str
    seconds: int
    #: For money: sums count whole units of 10^-digits, so they are exact in every plan and order.
    digits: int | None = None


HOUR, DAY, WEEK = 3_600, 86_400, 604_800

# The rolling features of the gold table.
CARD_FEATURES = [
    Rolling("tx_count_1h", "count", "transaction_id", HOUR),
    Rolling("tx_amount_1h", "sum", "abs_amount", HOUR, MONEY_DIGITS),
    Rolling("tx_count_24h", "count", "transaction_id", DAY),
    Rolling("tx_amount_24h", "sum", "abs_amount", DAY, MONEY_DIGITS),
    Rolling("avg_amount_24h", "avg", "abs_amount", DAY, MONEY_DIGITS),
    Rolling("std_amount_24h", "std", "abs_amount", DAY, MONEY_DIGITS),
    Rolling("unique_merchants_24h", "distinct", "merchant_id", DAY),
    Rolling("unique_states_24h", "distinct", "merchant_state", DAY),
    Rolling("tx_count_7d", "count", "transaction_id", WEEK),
    Rolling("tx_amount_7d", "sum", "abs_amount", WEEK, MONEY_DIGITS),
]


def rolling_windows(df: DataFrame, key: str, ts: str, specs: Sequence[Rolling]) -> DataFrame:
    """All features in one select over a seconds column computed once.

    Casting the time inside each window would give every feature its own sort.
    """
    whole = _whole_units(specs)
    timed = df.withColumns({_SEC: epoch_seconds(F.col(ts)), **whole})
    parts: dict[str, Column] = {}

    def part(spec: Rolling, name: str, value: Column) -> Column:
        """An aggregate over the spec's frame, computed once for all features that need it."""
        frame = Window.partitionBy(key).orderBy(_SEC).rangeBetween(-spec.seconds, 0)
        parts[f"{name}{spec.seconds}"] = value.over(frame)
        return F.col(f"{name}{spec.seconds}")

    def feature(spec: Rolling) -> Column:
        if spec.agg != "count" and spec.digits is not None:
            column = _unit_name(spec)
            u = F.col(column)
            n, total = part(spec, f"_n{column}", F.count(u)), part(spec, f"_s{column}", F.sum(u))
            squares = part(spec, f"_q{column}", F.sum(_square(u))) if spec.agg == "std" else None
            return _of_units(spec, n, total, squares).alias(spec.name)
        frame = Window.partitionBy(key).orderBy(_SEC).rangeBetween(-spec.seconds, 0)
        value = F.col(spec.column)
        if spec.agg == "distinct":
            return F.size(F.collect_set(value).over(frame)).cast("bigint").alias(spec.name)
        fold = {"count": F.count, "sum": F.sum, "avg": F.avg, "std": F.stddev_samp}[spec.agg]
        return fold(value).over(frame).alias(spec.name)

    features = [feature(spec) for spec in specs]
    return timed.select("*", *[expr.alias(name) for name, expr in parts.items()]).select("*", *features).drop(
        _SEC, *whole, *parts
    )


def _unit_name(spec: Rolling) -> str:
    return f"_u{spec.digits}_{spec.column}"


def _whole_units(specs: Sequence[Rolling]) -> dict[str, Column]:
    return {
        _unit_name(spec): units(F.col(spec.column), spec.digits)
        for spec in specs
        if spec.digits is not None and spec.agg in ("sum", "avg", "std")
    }


def _square(whole: Column) -> Column:
    wide = whole.cast("decimal(19,0)")
    return wide * wide


def _of_units(spec: Rolling, n: Column, total: Column, squares: Column | None) -> Column:
    """The feature from a frame's count, sum and sum of squares of whole units; one rounding at the end."""
    one = 10**spec.digits
    if spec.agg == "sum":
        return F.when(n > 0, total.cast("double") / float(one))
    if spec.agg == "avg":
        return F.when(n > 0, total.cast("double") / (n * one).cast("double"))
    spread = n.cast("decimal(19,0)") * squares - _square(total)
    return F.when(n > 1, F.sqrt(spread.cast("double") / (n * (n - 1)).cast("double")) / float(one))


def rolling_sliced(df: DataFrame, key: str, ts: str, specs: Sequence[Rolling]) -> DataFrame:
    """The same features with bounded groups and linear cost, for keys of any size.

    The key travels as text derived from it: were it the plain column, rows that
    arrive hash-partitioned by it (after a join on the key, say) would count as
    grouped well enough for every step below, and a hot key would stay in one task.
    """
    who = F.coalesce(F.concat(F.col(key).cast("string"), F.lit("=")), F.lit(""))
    time = F.coalesce(epoch_seconds(F.col(ts)), F.lit(_NO_TIME))
    rows = df.withColumns({_WHO: who, _SEC: time, **_whole_units(specs)})
    whole = [spec for spec in specs if spec.agg in ("count", "distinct") or spec.digits is not None]
    rest = [spec for spec in specs if spec not in whole]
    seconds = _per_second(rows, specs)
    if whole:
        seconds = _add_whole_frames(seconds, rows, whole)
    for length in sorted({spec.seconds for spec in rest}):
        due = [spec for spec in rest if spec.seconds == length]
        seconds = _add_frame(seconds, length, due)
    # AQE splits the row side if one second of one key is itself oversized.
    return rows.join(seconds.select(_WHO, _SEC, *[spec.name for spec in specs]), [_WHO, _SEC], "left").select(
        *df.columns, *[spec.name for spec in specs]
    )


def crowded_keys(df: DataFrame, key: str, ts: str, length: int, frame_rows: int) -> DataFrame:
    """Keys with more than ``frame_rows`` rows in two neighbouring slices of ``length`` seconds.

    No frame of that length holds more rows than two neighbouring slices do. Counts
    are combined before the shuffle.
    """
    timed = df.select(key, F.coalesce(epoch_seconds(F.col(ts)), F.lit(_NO_TIME)).alias(_SEC))
    counted = timed.groupBy(key, _slot(_SEC, length).alias("_slot")).agg(F.count(F.lit(1)).alias("_rows"))
    pairs = counted.select(key, "_rows", F.explode(F.array("_slot", F.col("_slot") + 1)).alias("_slot"))
    held = pairs.groupBy(key, "_slot").agg(F.sum("_rows").alias("_rows"))
    return held.filter(F.col("_rows") > frame_rows).select(key).distinct()


def rolling_features(
    df: DataFrame,
    key: str,
    ts: str,
    specs: Sequence[Rolling] = CARD_FEATURES,
    frame_rows: int = 2_000,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Rolling features with ordinary keys on range windows and crowded ones on slices.

    One counting job over key and time finds the keys whose frames may hold more than
    ``frame_rows`` rows; ``key_source`` may name a cheaper table with the same keys and
    times (say the stored fact behind a joined ``df``). The keys found stay a stored
    table, joined as its size allows, and the rows of those keys are stored once, as
    the sliced plan reads them several times.
    """
    source = df if key_source is None else key_source
    longest = max(spec.seconds for spec in specs)
    found = crowded_keys(source, key, ts, longest, frame_rows).withColumnRenamed(key, _CROWDED)
    if found.isEmpty():  # as a rule; nothing is stored then
        return rolling_windows(df, key, ts, specs)
    found = cut_lineage(found)
    is_crowded = F.col(key).eqNullSafe(F.col(_CROWDED))
    crowded = cut_lineage(df.join(found, is_crowded, "left_semi"))
    rest = df.join(found, is_crowded, "left_anti")
    return rolling_windows(rest, key, ts, specs).unionByName(rolling_sliced(crowded, key, ts, specs))


# --- sliced plan --------------------------------------------------------------------


def _per_second(rows: DataFrame, specs: Sequence[Rolling]) -> DataFrame:
    """One row per (key, second): count, sum and squared deviation of each column."""
    measures: dict[str, Column] = {}
    for spec in specs:
        value = F.col(spec.column)
        if spec.agg in ("sum", "avg", "std") and spec.digits is not None:
            u = F.col(_unit_name(spec))
            measures[f"_n{_unit_name(spec)}"] = F.count(u)
            measures[f"_s{_unit_name(spec)}"] = F.sum(u)
            if spec.agg == "std":
                measures[f"_q{_unit_name(spec)}"] = F.sum(_square(u))
            continue
        if spec.agg != "distinct":
            measures[f"_n_{spec.column}"] = F.count(value)
        if spec.agg in ("sum", "avg", "std"):
            measures[f"_s_{spec.column}"] = F.sum(value)
        if spec.agg == "std":
            measures[f"_m_{spec.column}"] = F.var_pop(value) * F.count(value)
    if not measures:
        return rows.select(_WHO, _SEC).distinct()
    return rows.groupBy(_WHO, _SEC).agg(*[expr.alias(name) for name, expr in measures.items()])


def _slot(sec: str, length: int) -> Column:
    return F.expr(f"({sec} - pmod({sec}, {length}L)) div {length}L")


def _offset(sec: str, length: int) -> Column:
    return F.expr(f"pmod({sec}, {length}L)")


def _measures(spec: Rolling) -> list[str]:
    """Columns of ``_per_second`` that a feature of whole numbers is made of."""
    if spec.agg == "count":
        return [f"_n_{spec.column}"]
    return [f"_{part}{_unit_name(spec)}" for part in ("nsq" if spec.agg == "std" else "ns")]


def _add_whole_frames(seconds: DataFrame, rows: DataFrame, specs: Sequence[Rolling]) -> DataFrame:
    """``seconds`` with the features that are made of whole numbers, of all frame lengths in one pass.

    Every second asks for the running totals at itself and just before each of its
    frames. Asking rows (``_ask``: 0 for the second itself) travel with the totals.
    """
    summed = [spec for spec in specs if spec.agg != "distinct"]
    distincts = [spec for spec in specs if spec.agg == "distinct"]
    names = sorted({name for spec in summed for name in _measures(spec)})
    lengths = sorted({spec.seconds for spec in summed})
    places = [F.struct(F.lit(0).alias("_ask"), F.col(_SEC).alias("_at"))]
    places += [
        F.struct(F.lit(i).alias("_ask"), (F.col(_SEC) - length - 1).alias("_at")) for i, length in enumerate(lengths, 1)
    ]
    events = seconds.select(_WHO, F.col(_SEC).alias("_of"), *names, F.inline(F.array(*places)))
    events = events.withColumns({name: F.when(F.col("_ask") == 0, F.col(name)) for name in names})
    gone = [f"_d{i}" for i in range(len(distincts))]
    if distincts:
        events = events.unionByName(_comings_and_goings(rows, distincts), allowMissingColumns=True)
    totals = [*names, *gone]

    # Dealt once; the totals of days and the running sums both read this exchange.
    dealt = events.withColumn("_slot", _slot("_at", DAY)).repartition(_WHO, "_slot")
    days = dealt.groupBy(_WHO, "_slot").agg(*[F.sum(name).alias(name) for name in totals])
    earlier = Window.partitionBy(_WHO).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    before = days.select(
        _WHO, "_slot", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_b{name}") for name in totals]
    )
    today = Window.partitionBy(_WHO, "_slot").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = dealt.join(before, [_WHO, "_slot"]).select(
        _WHO,
        "_of",
        "_ask",
        *[(F.col(f"_b{name}") + F.coalesce(F.sum(name).over(today), F.lit(0))).alias(name) for name in totals],
    )

    def at(ask: int, name: str) -> Column:
        return F.max(F.when(F.col("_ask") == ask, F.col(name)))

    answers = [at(0, name).alias(name) for name in gone]
    answers += [
        (at(0, name) - at(lengths.index(length) + 1, name)).alias(f"_f{length}{name}")
        for length, name in sorted({(spec.seconds, name) for spec in summed for name in _measures(spec)})
    ]
    answered = running.filter("_ask >= 0").groupBy(_WHO, F.col("_of").alias(_SEC)).agg(*answers)

    def feature(spec: Rolling) -> Column:
        if spec.agg == "distinct":
            return F.col(gone[distincts.index(spec)]).cast("bigint")
        parts = [F.col(f"_f{spec.seconds}{name}") for name in _measures(spec)]
        if spec.agg == "count":
            return parts[0]
        return _of_units(spec, *parts, *[None] * (3 - len(parts)))

    done = answered.select(_WHO, _SEC, *[feature(spec).alias(spec.name) for spec in specs])
    return seconds.join(done, [_WHO, _SEC])


def _comings_and_goings(rows: DataFrame, specs: Sequence[Rolling]) -> DataFrame:
    """Per (key, second), by how much each feature's number of distinct values changes (``_d<i>`` for ``specs[i]``).

    A sighting of a value at ``s`` counts until the value is seen again or leaves the
    frame, i.e. during ``[s, min(next sighting, s + length + 1))``.
    """
    columns = list(dict.fromkeys(spec.column for spec in specs))
    values = [
        F.struct(F.lit(i).alias("_column"), _as_text(rows, name).alias("_value")) for i, name in enumerate(columns)
    ]
    seen = rows.select(_WHO, _SEC, F.inline(F.array(*values))).filter(F.col("_value").isNotNull()).distinct()
    # The next sighting is looked up in stretches of several frames; a stretch also
    # sees the first frame of the one after it, where a next sighting in reach must lie.
    longest = max(spec.seconds for spec in specs)
    stretch = longest * _STRETCH
    own = _slot(_SEC, stretch)
    peeked = F.when(_offset(_SEC, stretch) <= longest, own - 1)
    spread = seen.select("*", own.alias("_home"), F.explode(F.array(own, peeked)).alias("_part")).filter(
        F.col("_part").isNotNull()
    )
    order = Window.partitionBy(_WHO, "_column", "_value", "_part").orderBy(_SEC)
    sightings = spread.withColumn("_again", F.lead(_SEC).over(order)).filter("_home = _part")

    def changes(i: int, spec: Rolling) -> list[Column]:
        here = F.col("_column") == columns.index(spec.column)
        ends = F.least(F.col(_SEC) + (spec.seconds + 1), F.col("_again"))
        return [
            F.when(here, F.struct(F.lit(i).alias("_feature"), at.alias("_at"), F.lit(step).cast("bigint").alias("_step")))
            for at, step in ((F.col(_SEC), 1), (ends, -1))
        ]

    listed = F.array(*[change for i, spec in enumerate(specs) for change in changes(i, spec)])
    return (
        sightings.select(_WHO, F.inline(listed))
        .filter(F.col("_feature").isNotNull())
        .groupBy(_WHO, "_at")
        .agg(*[F.sum(F.when(F.col("_feature") == i, F.col("_step"))).alias(f"_d{i}") for i in range(len(specs))])
        .withColumn("_ask", F.lit(-1))
    )


def _as_text(rows: DataFrame, name: str) -> Column:
    value = F.col(name)
    if rows.schema[name].dataType.typeName() in ("double", "float"):
        value = F.when(value == 0, F.lit(0).cast(rows.schema[name].dataType)).otherwise(value)  # -0.0 is 0.0
    return value.cast("string")


def _add_frame(seconds: DataFrame, length: int, specs: Sequence[Rolling]) -> DataFrame:
    """``seconds`` with sums of doubles over one frame length.

    Each row is placed in its own slice and, as a predecessor, in the next one.
    Within a slice ordered by offset, the frame of a row at offset ``o`` holds
    the slice's own rows up to ``o`` and the predecessors from ``o`` on.
    """
    slot = _slot(_SEC, length)
    placed = seconds.withColumn("_off", _offset(_SEC, length)).select(
        "*",
        F.inline(
            F.array(
                F.struct(slot.alias("_slot"), F.lit(True).alias("_own")),
                F.struct((slot + 1).alias("_slot"), F.lit(False).alias("_own")),
            )
        ),
    )
    group = Window.partitionBy(_WHO, "_slot")
    ahead = group.orderBy("_off").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    behind = group.orderBy(F.col("_off").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = group.orderBy("_off").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    # Squares are taken around the slice pair's mean, which keeps them small
    # enough that subtracting the frame's own mean loses no precision.
    for column in {spec.column for spec in specs if spec.agg == "std"}:
        n, s, m = (F.col(f"_{part}_{column}") for part in "nsm")
        centre = f"_c_{column}"
        # A NaN or infinity outside the frame must not reach it through the centre.
        finite = ~F.isnan(s.cast("double")) & (F.abs(s.cast("double")) < float("inf"))
        total, known = (F.sum(F.when(finite, part)).over(whole) for part in (s, n))
        placed = placed.withColumn(centre, F.coalesce(total / F.nullif(known, F.lit(0)), F.lit(0.0)))
        gap = s / F.nullif(n, F.lit(0)) - F.col(centre)
        placed = placed.withColumn(f"_q_{column}", m + n * gap * gap)

    needed = {f"_{part}_{spec.column}" for spec in specs for part in "ns"}
    needed |= {f"_q_{spec.column}" for spec in specs if spec.agg == "std"}
    totals = {f"_f{name}": _suffix_plus_prefix(name, behind, ahead) for name in sorted(needed)}
    summed = placed.select("*", *[expr.alias(name) for name, expr in totals.items()]).filter("_own")
    return summed.select(*seconds.columns, *[_finish(spec).alias(spec.name) for spec in specs])


def _suffix_plus_prefix(name: str, behind, ahead) -> Column:
    own = F.sum(F.when(F.col("_own"), F.col(name))).over(ahead)
    earlier = F.sum(F.when(~F.col("_own"), F.col(name))).over(behind)
    return F.coalesce(own, F.lit(0)) + F.coalesce(earlier, F.lit(0))


def _finish(spec: Rolling) -> Column:
    n, s = F.col(f"_f_n_{spec.column}"), F.col(f"_f_s_{spec.column}")
    if spec.agg == "sum":
        return F.when(n > 0, s)
    if spec.agg == "avg":
        return F.when(n > 0, s / n)
    shift = F.when(n > 1, s / n - F.col(f"_c_{spec.column}"))
    spread = F.col(f"_f_q_{spec.column}") - n * shift * shift
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))
