"""Time functions: localisation of naive wall-clock text to instants (with
daylight-saving gap and overlap rules), month ranges and epoch seconds.

Everything here is a plain Column expression except ``localize``, which
needs an ordered window for the autumn overlap hour.  No expression depends
on ``spark.sql.session.timeZone``: wall clocks are handled as microsecond
counts of ``timestamp_ntz`` values, and zone offsets are read with
``from_utc_timestamp`` on ``timestamp_micros``, both of which are
zone-independent.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
_DAY_US = 86_400_000_000
# A text ends with a time and a zone designator: Z, +hh, +hhmm or +hh:mm.  The
# time in front tells the sign of an offset from the dash of a date.
_OFFSET_RE = r":[0-9]{2}([.,][0-9]+)? ?(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wall_micros(ntz) -> Column:
    """Microseconds of a ``timestamp_ntz`` wall clock read as if it were UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ntz))


def ntz_from_micros(us) -> Column:
    """Inverse of ``wall_micros``."""
    return F.timestamp_add("MICROSECOND", _c(us), F.expr(_EPOCH_NTZ))


def utc_wallclock(ts) -> Column:
    """The UTC wall clock of an instant (``timestamp``) as ``timestamp_ntz``,
    whatever the session zone is."""
    return ntz_from_micros(F.unix_micros(_c(ts)))


def zone_offset_micros(instant_us, tz: str) -> Column:
    """UTC offset of zone ``tz`` at the instant given in epoch microseconds."""
    us = _c(instant_us)
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), tz)) - us


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch (fraction truncated), like
    ``unix_timestamp``; works for both timestamp types."""
    return F.unix_timestamp(_c(ts))


def localize(df: DataFrame, col: str = "measurement_time", tz: str = "Europe/Athens",
             order_col: str = "measurement_id", ambiguous: str = "infer",
             flag: str | None = None) -> DataFrame:
    """Turn wall-clock text (or ``timestamp_ntz``) in zone ``tz`` into instants.

    * text with an offset (``...+02:00``, ``...Z``) is that instant;
    * a wall clock inside the spring gap moves forward to the first valid
      instant (the transition itself: 03:30 on the change day -> 04:00 local);
    * a wall clock inside the autumn overlap occurs twice.  With
      ``ambiguous="infer"`` the arrival order (``order_col``, a number that
      grows with arrival; rows that tie are ordered by wall clock, and are no
      step where that is equal too; rows without one come first) decides: among the ambiguous rows of one transition
      date, rows before the one step that does not move forward take the
      summer offset, rows from that step on the winter offset.  Exactly one
      such step is required, otherwise the job fails, as the order cannot tell
      the two passes apart.  Rows of other hours that arrive in between do not
      split a date's rows.  Only the ambiguous rows are ordered
      (``_second_pass_starts``); the others are never shuffled.
      ``ambiguous="runs"`` looks at every run of ambiguous rows that arrive
      with no other row in between, and requires the one step of each of them;
      an overlap that other hours' rows split fails.  Here rows without an
      arrival number split nothing, and fail where they are ambiguous
      (``_run_switches``).
      ``ambiguous="earlier"`` / ``"later"`` pick one offset without looking;
      ``flag`` names a column that then tells which rows were such (see
      ``settle_overlap``).

    The gap rule assumes the transition happens on a whole hour and the gap
    lasts one hour, which holds for all European zones.
    """
    if ambiguous not in ("infer", "runs", "earlier", "later"):
        raise ValueError("ambiguous must be 'infer', 'runs', 'earlier' or 'later'")
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampType):            # already instants
        return df.withColumn(flag, F.lit(False)) if flag else df
    src = F.col(col)
    if isinstance(dtype, T.StringType):
        has_offset = src.rlike(_OFFSET_RE)
        ntz = F.when(~has_offset, F.to_timestamp_ntz(src))
        with_offset = F.when(has_offset, F.to_timestamp(src))
    else:
        has_offset, ntz, with_offset = F.lit(False), src, F.lit(None).cast("timestamp")

    # Each intermediate is its own column, computed once per row: written as
    # one nested expression, the parse and the zone lookups would be repeated
    # in every branch that uses them.
    c = F.col
    out = df.withColumns({"__off": with_offset, "__w": ntz})
    out = out.withColumn("__e", wall_micros("__w"))
    out = out.withColumns({"__oa": zone_offset_micros(c("__e") - _DAY_US, tz),   # before a change
                           "__ob": zone_offset_micros(c("__e") + _DAY_US, tz)})  # after it
    out = out.withColumns({"__ua": c("__e") - c("__oa"), "__ub": c("__e") - c("__ob")})
    # no change of offset within a day either side (almost every row): the
    # wall clock is valid and unique, skip the two checks
    calm = c("__oa") == c("__ob")
    out = out.withColumns({
        "__oka": F.when(calm, F.lit(True)).otherwise(zone_offset_micros("__ua", tz) == c("__oa")),
        "__okb": F.when(calm, F.lit(True)).otherwise(zone_offset_micros("__ub", tz) == c("__ob"))})
    out = out.withColumns({
        "__amb": c("__oka") & c("__okb") & (c("__ua") != c("__ub")),
        "__one": F.when(c("__oka"), c("__ua")).when(c("__okb"), c("__ub"))
                  .otherwise(wall_micros(F.date_trunc("hour", c("__w"))) - c("__oa")),
    })

    if ambiguous in ("infer", "runs"):
        same_date = F.when(c("__amb"), F.to_date("__w")) == c("__date")
        if ambiguous == "infer":
            # a few dates (clocks go back once or twice a year): a bounded broadcast
            switch = F.broadcast(_second_pass_starts(out, order_col))
        else:
            # no hint: the planner measures how many runs there are
            switch = _run_switches(out, order_col)
            same_date = same_date & c(order_col).between(c("__first"), c("__last"))
        out = out.join(switch, same_date, "left")
        second = c(order_col) >= c("__from")
        resolved = F.when(
            c("__steps") == 1, F.when(F.coalesce(second, F.lit(False)), c("__ub")).otherwise(c("__ua"))
        ).otherwise(F.raise_error(F.concat(
            F.lit("cannot infer the daylight-saving offset of "),
            F.coalesce(c("__w").cast("string"), F.lit("?")),
            F.lit(": the overlap rows of that date need exactly one backward step"))).cast("long"))
    elif ambiguous == "earlier":
        resolved = c("__ua")
    else:
        resolved = c("__ub")

    micros = F.when(c("__amb"), resolved).otherwise(c("__one"))
    value = F.when(c("__off").isNotNull(), c("__off")).otherwise(F.timestamp_micros(micros))
    out = out.withColumn(col, value)
    if flag:
        out = out.withColumn(flag, F.coalesce(c("__amb"), F.lit(False)))
    return out.drop(*[x for x in out.columns if x.startswith("__")])


def settle_overlap(df: DataFrame, col: str = "measurement_time", tz: str = "Europe/Athens",
                   order_col: str = "measurement_id") -> DataFrame:
    """The overlap rows that ``localize`` flagged and gave one offset without
    looking, with the offset that their arrival order tells."""
    wall = utc_wallclock(F.from_utc_timestamp(_c(col), tz))
    return localize(df.withColumn(col, wall), col, tz, order_col)


def _steps_back(order) -> Column:
    """The wall clock ``__t`` does not move forward from the row before.  Rows
    with equal clocks and one arrival number ``__o`` came at once: no step."""
    t, at = F.col("__t"), F.lag("__o").over(order)
    return (t < F.lag("__t").over(order)) | ((t == F.lag("__t").over(order)) & F.coalesce(F.col("__o") != at, F.lit(True)))


# Overlap rows of one date are ordered in ranges of this many arrival numbers.
_ORDER_BLOCK = 1 << 16


def _second_pass_starts(out: DataFrame, order_col: str) -> DataFrame:
    """Per date on which clocks go back: ``__steps``, how often the wall clock
    of its overlap rows does not move forward in arrival order, and ``__from``,
    the arrival number at which it last does not.

    Only overlap rows (an hour a year) and three narrow columns take part; all
    other rows pass by without a shuffle.  The order is looked at in ranges of
    arrival numbers, and then between the ranges' first and last rows, so one
    crowded hour is not one task."""
    c = F.col
    rows = (out.filter(c("__amb"))
            .select(F.to_date("__w").alias("__date"), c(order_col).alias("__o"), c("__e").alias("__t"),
                    F.floor(c(order_col) / F.lit(_ORDER_BLOCK)).alias("__blk")))
    inside = Window.partitionBy("__date", "__blk").orderBy("__o", "__t")
    steps = rows.withColumn("__back", _steps_back(inside))
    blocks = steps.groupBy("__date", "__blk").agg(
        # a step back at a row without an arrival number can't be placed: counts twice
        F.sum(F.when(c("__back"), F.when(c("__o").isNull(), 2).otherwise(1)).otherwise(0)).alias("__n"),
        F.max(F.when(c("__back"), c("__o"))).alias("__at"),
        F.min(F.struct("__o", "__t")).alias("__first"), F.max(F.struct("__o", "__t")).alias("__last"))
    between = Window.partitionBy("__date").orderBy(F.col("__blk").asc_nulls_first())
    # rows of two ranges never tie
    back = c("__first.__t") <= F.lag("__last.__t").over(between)
    blocks = blocks.withColumn("__b", F.coalesce(back, F.lit(False)))
    return blocks.groupBy("__date").agg(
        (F.sum("__n") + F.count(F.when(c("__b"), 1))).alias("__steps"),
        F.max(F.greatest("__at", F.when(c("__b"), c("__first.__o")))).alias("__from"))


# Blocks of arrival numbers are put in order in ranges of this many blocks.
_ORDER_RANGE = 1 << 12


def _run_switches(out: DataFrame, order_col: str) -> DataFrame:
    """Runs of ambiguous rows that follow each other in arrival order, one row
    per run and date: ``__first`` and ``__last`` arrival number, ``__steps``,
    how often the wall clock does not move forward, and ``__from``, the number
    at which it last does not.

    Gaps and islands at two levels: rows are put in order only inside blocks
    of arrival numbers that hold an ambiguous row (three narrow columns, an
    hour a year), where they form pieces of runs.  Of all other blocks only
    their existence counts: which block has the rows before a block is found
    inside ranges of blocks, and between the ranges by one row each.  Pieces
    that touch across two blocks are then joined by a running number over the
    (at most two) pieces a block has at its edges."""
    c = F.col
    rows = (out.where(c(order_col).isNotNull())
            .select(F.floor(c(order_col) / F.lit(_ORDER_BLOCK)).alias("__blk"), c(order_col).alias("__o"),
                    c("__e").alias("__t"), F.coalesce("__amb", F.lit(False)).alias("__a")))
    blocks = (rows.groupBy("__blk").agg(F.max("__a").alias("__hot"))
              .withColumn("__rng", F.floor(c("__blk") / F.lit(_ORDER_RANGE))))
    ranges = (blocks.groupBy("__rng").agg(F.max("__blk").alias("__end"))
              .withColumn("__end", F.lag("__end").over(Window.orderBy("__rng"))))     # a row per range
    before = F.lag("__blk").over(Window.partitionBy("__rng").orderBy("__blk"))
    hot = (blocks.withColumn("__in", before).join(ranges, "__rng").where("__hot")
           .select("__blk", F.coalesce("__in", "__end").alias("__prev")))

    order = Window.partitionBy("__blk").orderBy("__o", "__t")
    placed = (rows.join(hot, "__blk")
              .withColumns({"__was": F.coalesce(F.lag("__a").over(order), F.lit(False)),
                            "__back": _steps_back(order),
                            "__n": F.row_number().over(order)})
              .withColumn("__k", F.sum(F.when(c("__a") & ~c("__was"), 1).otherwise(0)).over(order)))
    size = placed.groupBy("__blk").agg(F.max("__n").alias("__rows"))
    back = c("__back") & c("__was")
    pieces = (placed.where("__a")
              .groupBy("__blk", "__prev", "__k").agg(
                  F.min(F.struct("__o", "__t")).alias("__lo"), F.max(F.struct("__o", "__t")).alias("__hi"),
                  F.min("__n").alias("__n0"), F.max("__n").alias("__n1"),
                  F.count(F.when(back, 1)).alias("__steps"), F.max(F.when(back, c("__o"))).alias("__from"),
                  F.collect_set(F.to_date(ntz_from_micros("__t"))).alias("__dates"))      # overlap dates
              .join(size, "__blk")
              .withColumns({"__open": c("__n0") == 1, "__goes_on": c("__n1") == c("__rows")}))
    keep = ["__lo", "__hi", "__steps", "__from", "__dates"]
    inner = pieces.where(~c("__open") & ~c("__goes_on")).select(*keep)

    along = Window.orderBy("__lo")
    edge = pieces.where(c("__open") | c("__goes_on"))
    edge = edge.withColumn("__joined", F.coalesce(
        c("__open") & F.lag("__goes_on").over(along) & (F.lag("__blk").over(along) == c("__prev")), F.lit(False)))
    edge = edge.withColumns({
        "__run": F.sum(F.when(c("__joined"), 0).otherwise(1)).over(along),
        "__b": c("__joined") & (c("__lo.__t") <= F.lag("__hi.__t").over(along))})
    whole = edge.groupBy("__run").agg(
        F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
        (F.sum("__steps") + F.count(F.when(c("__b"), 1))).alias("__steps"),
        F.max(F.greatest("__from", F.when(c("__b"), c("__lo.__o")))).alias("__from"),
        F.array_distinct(F.flatten(F.collect_list("__dates"))).alias("__dates"))
    return (inner.unionByName(whole.select(*keep))
            .select(F.explode("__dates").alias("__date"), c("__lo.__o").alias("__first"),
                    c("__hi.__o").alias("__last"), "__steps", "__from"))


# ---------------------------------------------------------------- months

def month_bounds(d) -> tuple[Column, Column]:
    """First and last day of the month of a date column."""
    d = _c(d)
    return F.trunc(d, "MM"), F.last_day(d)


def month_series(start, end) -> Column:
    """Array of month starts from ``start``'s month to ``end``'s month, both
    included; empty when start is after end."""
    s, e = F.trunc(_c(start), "MM"), F.trunc(_c(end), "MM")
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 month"))) \
        .otherwise(F.array().cast("array<date>"))


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Months ``YYYY-MM`` .. ``YYYY-MM`` (inclusive) with their first and last
    day; an empty frame when start is after end."""
    base = spark.range(1).select(
        F.explode(month_series(F.to_date(F.lit(start + "-01")),
                               F.to_date(F.lit(end + "-01")))).alias("month_start"))
    return base.select(
        F.year("month_start").alias("year"), F.month("month_start").alias("month"),
        F.col("month_start").alias("first_day"), F.last_day("month_start").alias("last_day"))


def default_month_of(day, mode: str = "monthly") -> Column:
    """Column form of ``default_month``: first day of the month that a run on
    ``day`` works on."""
    if mode not in ("monthly", "daily"):
        raise ValueError("mode must be 'monthly' or 'daily'")
    return F.trunc(F.add_months(_c(day), -1 if mode == "monthly" else 0), "MM")


def default_month(today: _dt.date, mode: str = "monthly") -> tuple[int, int]:
    """Month a scheduled run works on: the previous month for ``monthly``,
    the current month for ``daily``."""
    if mode == "daily":
        return today.year, today.month
    if mode != "monthly":
        raise ValueError("mode must be 'monthly' or 'daily'")
    return (today.year - 1, 12) if today.month == 1 else (today.year, today.month - 1)

