"""Public registers to evidence: one declarative specification a source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text


def newest(df: DataFrame, keys: list[str], day: str, ties: list[str] = ()) -> DataFrame:
    """The newest row of each key; on equal dates the first by ``ties``."""
    w = W.partitionBy(*keys).orderBy(F.desc_nulls_last(day), *ties)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def max_date_group(df: DataFrame, keys: list[str], day: str, floor: date) -> DataFrame:
    """The keys with their last date, if it is at least ``floor``."""
    return df.groupBy(*keys).agg(F.max(day).alias(day)).where(F.col(day) >= F.lit(floor))


def first_rows(df: DataFrame, keys: list[Column], order: list) -> DataFrame:
    """The first row of each key: one row a premises."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def newest_period(df: DataFrame, period: str) -> DataFrame:
    """Only rows of the table's last period."""
    last = df.agg(F.max(period).alias("_last"))
    return df.join(F.broadcast(last), F.col(period) == F.col("_last")).drop("_last")  # one row


def latest_of(*days: Column) -> Column:
    """The latest of several dates, nulls passed over."""
    return F.greatest(*days)


def deactivated(off: Column, on: Column) -> Column:
    """Whether a record went out and did not come back since."""
    return off.isNotNull() & (on.isNull() | (on < off))


def unexpired(df: DataFrame, column: str, today: date, strict: bool = False, on_bad: str = "keep") -> DataFrame:
    """Rows whose expiry, in any known date form, is not past (``strict``: later than today); unreadable or blank ones
    are kept or dropped by ``on_bad``."""
    day = text.parse_date(F.col(column).cast("string"))
    fresh = day > F.lit(today) if strict else day >= F.lit(today)
    return df.where(F.coalesce(fresh, F.lit(on_bad == "keep")))


def skip_reissued(cancelled: DataFrame, live: DataFrame, keys: list[str]) -> DataFrame:
    """Cancellations without those whose (upper-cased, trimmed) keys hold an active licence."""
    k = lambda df, c: F.upper(F.trim(df[c]))
    on = None
    for c in keys:
        on = (k(cancelled, c) == k(live, c)) if on is None else on & (k(cancelled, c) == k(live, c))
    return cancelled.join(live.select(*keys), on, "left_anti")


def with_position(rows: DataFrame, facilities: DataFrame, key: str) -> DataFrame:
    """Rows with lat and lng of their facility, one position a facility."""
    spots = facilities.groupBy(key).agg(F.min_by(F.struct("lat", "lng"), F.struct("lat", "lng")).alias("_p"))
    return rows.drop("lat", "lng").join(spots, key, "left").withColumns({"lat": F.col("_p.lat"), "lng": F.col("_p.lng")}).drop("_p")


def trade_filter(c: Column, allow: list[str] = (), deny: list[str] = (), prefixes: list[str] = (), not_prefixes: list[str] = (), values: list[str] = ()) -> Column:
    """Keep by words in the text (case does not count), code prefixes with exceptions, or a set of codes."""
    out = F.lit(True)
    if allow:
        out = out & c.rlike(f"(?i){'|'.join(allow)}")
    if deny:
        out = out & ~c.rlike(f"(?i){'|'.join(deny)}")
    if prefixes:
        any_ = F.lit(False)
        for p in prefixes:
            any_ = any_ | c.startswith(p)
        out = out & any_
    for p in not_prefixes:
        out = out & ~c.startswith(p)
    return out & c.isin(*values) if values else out


@dataclass
class RegisterSpec:
    """How a landed register becomes evidence. Columns are expressions over its own columns; ``state`` may depend on the
    row (a register of open and closed records); ``source`` too."""

    source: str | Column
    id: Column
    name: Column
    address: Column
    state: str | Column = "open"
    day: Column | None = None
    as_of: date | None = None
    lat: Column | None = None
    lng: Column | None = None
    keep: Column | None = None
    expires: str | None = None
    undated: str = "keep"
    newest_by: list[str] = field(default_factory=list)
    newest_day: str | None = None
    dedupe: list[Column] = field(default_factory=list)
    order: list[str] = field(default_factory=list)
    unless_live: tuple[DataFrame, list[str]] | None = None
    period: str | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None


def normalize_register(raw: DataFrame, spec: RegisterSpec, today: date) -> DataFrame:
    """Evidence rows (source, source_id, name, address, lat, lng, state, date) of one register."""
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    df = spec.prepare(raw) if spec.prepare else raw
    if spec.keep is not None:
        df = df.where(spec.keep)
    if spec.period:
        df = newest_period(df, spec.period)
    if spec.expires:
        df = unexpired(df, spec.expires, today, on_bad=spec.undated)
    if spec.newest_by:
        df = newest(df, spec.newest_by, spec.newest_day, spec.order)
    if spec.dedupe:
        df = first_rows(df, spec.dedupe, spec.order)
    if spec.unless_live:
        df = skip_reissued(df, *spec.unless_live)
    null = F.lit(None).cast("double")
    day = spec.day if spec.day is not None else F.lit(spec.as_of or today)
    cols = {"source": lit(spec.source), "source_id": spec.id, "name": F.trim(spec.name), "address": F.trim(spec.address), "lat": spec.lat if spec.lat is not None else null, "lng": spec.lng if spec.lng is not None else null, "state": lit(spec.state), "date": day.cast("date")}
    return df.select(*[c.alias(n) for n, c in cols.items()])


def normalize_many(raws: dict[str, DataFrame], specs: dict[str, RegisterSpec], today: date) -> DataFrame:
    """The union of several registers, each by its own specification."""
    out = None
    for name, spec in specs.items():
        part = normalize_register(raws[name], spec, today)
        out = part if out is None else out.unionByName(part)
    return out


def plausible(out: DataFrame, before: DataFrame, least: float = 0.5) -> DataFrame:
    """(source, rows, before, ok): whether each source has at least ``least`` of the rows it had."""
    now = out.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    then = before.groupBy("source").agg(F.count(F.lit(1)).alias("before"))
    both = then.join(now, "source", "left").select("source", F.coalesce("rows", F.lit(0)).alias("rows"), "before")
    return both.withColumn("ok", F.col("rows") >= F.lit(least) * F.col("before"))


def apply_geocodes(ev: DataFrame, answers: DataFrame) -> DataFrame:
    """Evidence with missing positions filled from (address, lat, lng) answers."""
    a = answers.where("lat is not null").select(F.col("address").alias("_a"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
    out = ev.join(a, (ev.address == F.col("_a")) & ev.lat.isNull(), "left")
    return out.withColumns({"lat": F.coalesce("lat", "_lat"), "lng": F.coalesce("lng", "_lng")}).drop("_a", "_lat", "_lng")


def geocode_todo(ev: DataFrame, answers: DataFrame) -> DataFrame:
    """(address): well-formed addresses without position that no answer, also a miss, is known for."""
    todo = ev.where(F.col("lat").isNull() & F.col("address").rlike(r"^[0-9]+ .+, .+, [A-Z]{2} [0-9]{5}")).select("address").distinct()
    return todo.join(answers.select("address"), "address", "left_anti")


def merge_answers(*tables: DataFrame) -> DataFrame:
    """One answer an address: that of the last table that has it. Rows without an address or with half a position go."""
    out = None
    for i, t in enumerate(tables):
        part = t.where(F.col("address").isNotNull() & (F.col("lat").isNull() == F.col("lng").isNull())).withColumn("_p", F.lit(i))
        out = part if out is None else out.unionByName(part)
    best = out.groupBy("address").agg(F.max(F.struct("_p", "lat", "lng")).alias("b"))
    return best.select("address", F.col("b.lat").alias("lat"), F.col("b.lng").alias("lng"))


def new_answers(before: DataFrame, after: DataFrame) -> DataFrame:
    return after.join(before.select("address"), "address", "left_anti")
