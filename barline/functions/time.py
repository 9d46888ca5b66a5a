"""Time columns. Candle times are zone-less UTC, so nothing here depends on the session zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from barline.schemas import INTERVAL_SECONDS

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# Raw epochs at or above these are microseconds and milliseconds.
MICROS_FROM = 10**15
MILLIS_FROM = 10**12


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(col="open_time", offset=0) -> Column:
    """Whole Unix seconds of a zone-less time, less a fixed zone offset."""
    if isinstance(col, str):  # one call to the JVM instead of a dozen
        less = f" - {int(offset)}L" if offset else ""
        return F.expr(f"{_seconds_sql(col)}{less}")
    seconds = F.unix_date(F.to_date(col)).cast("bigint") * 86400 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    return seconds - F.lit(offset).cast("bigint") if offset else seconds


def _seconds_sql(t: str) -> str:
    return f"cast(unix_date(to_date({t})) as bigint) * 86400 + hour({t}) * 3600 + minute({t}) * 60 + second({t})"


def epoch_micros(col) -> Column:
    if isinstance(col, str):
        return F.expr(f"({_seconds_sql(col)}) * 1000000 + cast((extract(SECOND FROM {col}) - second({col})) * 1000000 as bigint)")
    fraction = F.extract(F.lit("SECOND"), col) - F.second(col)
    return epoch_seconds(col) * 1000000 + (fraction * 1000000).cast("bigint")


def ntz_from_seconds(seconds) -> Column:
    """Zone-less UTC time of a Unix-seconds column."""
    if isinstance(seconds, str):
        return F.expr(f"timestampadd(SECOND, {seconds}, {EPOCH})")
    return F.timestamp_add("SECOND", seconds, F.expr(EPOCH))


def ntz_from_micros(micros) -> Column:
    """The same of a column of Unix microseconds."""
    return F.timestamp_add("MICROSECOND", _col(micros), F.expr(EPOCH))


def ntz_literal(seconds: int) -> Column:
    """The same for one number, as a constant that the optimizer can push into a scan."""
    moment = datetime(1970, 1, 1) + timedelta(seconds=seconds)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_to_ntz(col) -> Column:
    """UTC time of a raw epoch in milli- or microseconds, told apart by size; NULL if neither."""
    t = _col(col)
    return F.when(t >= MICROS_FROM, F.timestamp_add("MICROSECOND", t, F.expr(EPOCH))).when(
        t >= MILLIS_FROM, F.timestamp_add("MILLISECOND", t, F.expr(EPOCH))
    )


def interval_seconds(col="interval") -> Column:
    """Length of a bar in seconds, of the column of that name; an unknown interval counts as the shortest one."""
    pairs = ", ".join(f"'{name}', {seconds}L" for name, seconds in INTERVAL_SECONDS.items())
    return F.expr(f"coalesce(try_element_at(map({pairs}), {col}), {min(INTERVAL_SECONDS.values())})")


def instant_micros(df, col) -> Column:
    """Microseconds since the epoch of a time column; a zone-less time is taken for UTC."""
    return epoch_micros(col) if df.schema[col].dataType.typeName() == "timestamp_ntz" else F.unix_micros(col)


def event_order(micros: str, sequence: str) -> Column:
    """One number that sorts as (time in microseconds, sequence), from two columns by name.

    min_by and max_by ordered by a struct fall back to sort aggregation; ordered by a
    number they stay hash aggregates, so rows need no sort before the partial step.
    """
    wide = "cast({} as decimal(38,0))"
    product = f"{wide.format(micros)} * {wide.format(f"'{2**64}'")}"
    return F.expr(wide.format(f"cast({product} as decimal(38,0)) + {wide.format(sequence)}"))


# Where the first bar of a length begins that does not divide a day. Weeks open on
# Mondays; 1970-01-05 was one.
ORIGIN = {"1w": 4 * 86400}


def bar_bounds(interval: str, epoch: str) -> tuple[str, str]:
    """SQL for the Unix seconds of the start of the bar that holds a moment, a bigint column, and of the next bar's start.

    Months are calendar months; three-day bars count from 1970-01-01.
    """
    if interval == "1M":
        month = f"trunc(date_from_unix_date(cast(floor({epoch} / 86400) as int)), 'MONTH')"
        return tuple(f"(cast(unix_date({day}) as bigint) * 86400)" for day in (month, f"add_months({month}, 1)"))
    width = INTERVAL_SECONDS[interval]
    start = f"({epoch} - pmod({epoch} - {ORIGIN.get(interval, 0)}L, {width}L))"
    return start, f"({start} + {width}L)"


def bar_number(time: str) -> Column:
    """Number of the bar of the column `interval` that holds a zone-less time: bars of an interval count on without a gap.

    NULL for an unknown interval.
    """
    cases = " ".join(f"when '{i}' then floor(({_seconds_sql(time)} - {ORIGIN.get(i, 0)}) / {n}L)" for i, n in INTERVAL_SECONDS.items() if i != "1M")
    return F.expr(f"case interval when '1M' then cast(year({time}) * 12 + month({time}) - 1 as bigint) {cases} end")


def bar_start(number: str) -> Column:
    """The opening time of a numbered bar of the column `interval`."""
    cases = " ".join(f"when '{i}' then {number} * {n}L + {ORIGIN.get(i, 0)}" for i, n in INTERVAL_SECONDS.items() if i != "1M")
    month = f"make_date(cast({number} div 12 as int), cast({number} % 12 + 1 as int), 1)"
    return F.expr(f"case interval when '1M' then cast({month} as timestamp_ntz) else timestampadd(SECOND, case interval {cases} end, {EPOCH}) end")
