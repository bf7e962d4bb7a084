"""Stream forms of the keyed rules, on Spark's keyed state.

Each processor keeps one small value per key.  Rows of a key may arrive in
several chunks per micro-batch and in any order inside it; a chunk is a bounded
Arrow batch, and what outlives it is state, never a list of rows.  Rules that
hold rows until their time has come (bounces, last wins, order lines) are
aggregates over event-time windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timefmt import seconds, watermarked

# Row tuples rename columns that start with an underscore, so none here does.
_MS = "event_ms"


def _state(name: str, kind: T.DataType) -> T.StructType:
    # Built without the DDL parser, which needs a session that workers lack.
    return T.StructType([T.StructField(name, kind)])


def _run(df: DataFrame, key: str, processor: StatefulProcessor, extra: str, ts: str, delay: str, by_row: bool = False) -> DataFrame:
    """Group a timed stream by key and run the processor on event time; `by_row` hands it rows, not data frames."""
    timed = watermarked(df.withColumn(_MS, F.unix_millis(ts)), ts, delay)
    fields = [f for f in timed.schema.fields if f.name != _MS]
    schema = T.StructType(fields + list(T.StructType.fromDDL(extra).fields if extra else []))
    processor.columns = schema.names
    grouped = timed.groupBy(key)
    run = grouped.transformWithState if by_row else grouped.transformWithStateInPandas
    return run(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName=ts,
    )


class _Base(StatefulProcessor):
    columns: list[str] = []

    def close(self) -> None:
        pass

    def _out(self, rows: pd.DataFrame) -> pd.DataFrame:
        return rows[self.columns].reset_index(drop=True)


class DayOpeners(_Base):
    """First row per day of a key, with `is_first` and `days_away`.

    Per micro-batch the earliest row of each new day is kept, then the days are
    compared with the last day in state.
    """

    def __init__(self, day: str):
        self.day = day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _state("day", T.StringType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best: pd.DataFrame | None = None
        for chunk in rows:
            pool = chunk if best is None else pd.concat([best, chunk])
            best = pool.sort_values(_MS, kind="stable").drop_duplicates(self.day)
        last = self.last.get()[0] if self.last.exists() else None
        picked = []
        for at, day in enumerate(best[self.day]):
            if day == last:
                continue
            away = None if last is None else (pd.Timestamp(day) - pd.Timestamp(last)).days
            picked.append((at, last is None, away))
            last = day
        if picked:
            self.last.update((last,))
            out = best.iloc[[p[0] for p in picked]].copy()
            out["is_first"] = [p[1] for p in picked]
            out["days_away"] = pd.array([p[2] for p in picked], dtype="Int32")
            yield self._out(out)


def day_openers(df: DataFrame, key: str, day: str, ts: str, delay: str = "2 seconds") -> DataFrame:
    """Stream form of `operators.keyed.day_changes` (daily unique, first day, return)."""
    return _run(df, key, DayOpeners(day), "is_first boolean, days_away int", ts, delay)


class DayFirsts(_Base):
    """First row of each day of a key, with state that time takes away.

    State is the list of the key's open days.  A day is open until the watermark
    passes its end: later rows of it are dropped as late before they get here,
    so nothing can ask for the day again.  A key has one timer, at the end of its
    first open day; it removes all days that have ended and goes on to the next
    one's end.  A key without open days has no state.  Keys are many and their
    rows few, so it takes rows: a data frame for each key costs more than the rule.
    """

    def __init__(self, day: str, zone: str):
        self.day, self.zone = day, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _state("days", T.ArrayType(T.StringType())))
        self.ends: dict[str, int] = {}

    def _end(self, day: str) -> int:
        """The first millisecond after the day; a day of a zone may have 23 or 25 hours."""
        if day not in self.ends:
            midnight = pd.Timestamp(day) + pd.Timedelta(days=1)
            self.ends[day] = int(midnight.tz_localize(self.zone, nonexistent="shift_forward", ambiguous=True).timestamp() * 1000)
        return self.ends[day]

    def _days(self) -> list[str]:
        held = self.open.get()
        return list(held[0]) if held is not None else []

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seen = self._days()
        best: dict[str, Row] = {}
        for row in rows:
            day = row[self.day]
            if day is not None and day not in seen and (day not in best or row[_MS] < best[day][_MS]):
                best[day] = row
        if not best:
            return
        first = min(map(self._end, best))
        before = min(map(self._end, seen), default=None)
        if before is None or first < before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(first)
        self.open.update((seen + list(best),))
        for row in sorted(best.values(), key=lambda r: r[_MS]):
            yield Row(**{c: row[c] for c in self.columns})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        left = [day for day in self._days() if self._end(day) > now]
        if left:
            self.open.update((left,))
            self.handle.registerTimer(min(map(self._end, left)))
        else:
            self.open.clear()
        return iter(())


def day_firsts(df: DataFrame, key: str, day: str, ts: str, delay: str = "2 seconds") -> DataFrame:
    """Stream form of `operators.keyed.day_firsts`; `day` is the day of `ts` in the session's zone.

    State of a day is gone once the watermark is past its end.  Rows without a
    day are dropped.  What needs the days before, use `day_openers`.
    """
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return _run(df, key, DayFirsts(day, zone), "", ts, delay, by_row=True)


class NewFlagRepair(_Base):
    """First-visit day of a visitor; written once and kept."""

    def __init__(self, zone: str):
        self.zone = zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", _state("day", T.StringType()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = self.first.get()[0] if self.first.exists() else None
        if first is None:
            # The first day hangs on the earliest row of all chunks.  One visitor's rows of one micro-batch are held,
            # which the source's limit per trigger bounds.
            rows = list(rows)
            opener = min((c.loc[c[_MS].idxmin()] for c in rows if len(c)), key=lambda r: r[_MS])
            opened = pd.Timestamp(opener[_MS], unit="ms", tz="UTC").tz_convert(self.zone)
            first = (opened if opener["is_new"] == "1" else opened - pd.Timedelta(days=1)).strftime("%Y-%m-%d")
            self.first.update((first,))
        for chunk in rows:
            when = pd.to_datetime(chunk[_MS], unit="ms", utc=True).dt.tz_convert(self.zone)
            wrong = (chunk["is_new"] == "1") & (when.dt.strftime("%Y-%m-%d") != first)
            yield self._out(chunk.assign(is_new=chunk["is_new"].mask(wrong, "0")))


def repair_new_flag(df: DataFrame, key: str, ts: str, delay: str = "2 seconds") -> DataFrame:
    """Stream form of the flag repair, over rows with flat `is_new`."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return _run(df, key, NewFlagRepair(zone), "", ts, delay)


def _plain(df: DataFrame, ts: str) -> list[Column]:
    """All columns; the time without its watermark, as rows that were held must not flow into another stateful operator."""
    return [F.timestamp_micros(F.unix_micros(c)).alias(c) if c == ts else F.col(c) for c in df.columns]


def bounces(df: DataFrame, key: str, entry: str, ts: str, gap: str = "10 seconds", delay: str = "2 seconds") -> DataFrame:
    """Stream form of `operators.keyed.bounces`; `entry` is a boolean column.

    Rows of a key are collected in windows of two gaps that open every gap, and
    put in order of time (of equal times, of arrival) when the watermark has
    passed a window.  Its first half is judged there: whatever follows inside
    the gap lies in the same window.
    """
    size = seconds(gap)
    span = F.window(ts, f"{2 * size} seconds", f"{size} seconds")
    row = F.struct(F.unix_millis(ts).alias("ms"), F.struct(*_plain(df, ts)).alias("row"))
    held = watermarked(df, ts, delay).groupBy(F.col(key).alias("_key"), span.alias("_span")).agg(F.collect_list(row).alias("rows"))

    def by_time(a: Column, b: Column) -> Column:
        return F.when(a["ms"] < b["ms"], -1).when(a["ms"] > b["ms"], 1).otherwise(0)

    held = held.select(
        F.array_sort("rows", by_time).alias("rows"), (F.unix_millis("_span.start") + size * 1000).alias("half")
    )
    pairs = F.transform("rows", lambda r, i: F.struct(r.alias("one"), F.get("rows", i + 1).alias("next")))

    def bounced(pair: Column) -> Column:
        one, after = pair["one"], pair["next"]
        alone = after.isNull() | (after["ms"] - one["ms"] >= size * 1000) | F.coalesce(after["row"][entry], F.lit(False))
        return F.coalesce(one["row"][entry], F.lit(False)) & (one["ms"] < F.col("half")) & alone

    return held.select(F.explode(F.filter(pairs, bounced)).alias("pair")).select("pair.one.row.*")


def last_wins(df: DataFrame, key: str, version: str, ts: str, hold: str = "5 seconds", delay: str = "2 seconds") -> DataFrame:
    """Newest version of a row; the hold runs on event time `ts`.

    Versions of a key that follow each other within `hold` are one group, and its
    newest one (of equal ones, the last to arrive) is given out once time has
    passed the hold.  State is one row for each group that is still held.
    """
    held = watermarked(df, ts, delay).groupBy(F.col(key).alias("_key"), F.session_window(ts, hold).alias("_span"))
    return held.agg(F.max_by(F.struct(*_plain(df, ts)), F.struct(version)).alias("best")).select("best.*")


def first_wins(df: DataFrame, key: str, ts: str, ttl: str = "5 seconds") -> DataFrame:
    """First-wins de-dup; Spark's own operator, the delay being the memory."""
    return watermarked(df, ts, ttl).dropDuplicatesWithinWatermark([key])


#: The kinds of parts that an order's lines are put together from.
LINE, ACTIVITY, COUPON, ORDER = "line", "activity", "coupon", "order"


def order_lines(parts: DataFrame, extras_within: str, order_within: str, delay: str = "2 seconds") -> DataFrame:
    """Joined payloads of a stream of parts: `order_id`, `kind`, `line`, `version`, `payload`, `at`.

    A line is given out once, with the newest activity and coupon and every order
    version inside the bounds, in whatever order these arrive; lines that no
    version of their order meets are given up.  Parts meet in windows that
    overlap by the longer bound on both sides: a line lies in the core of one
    window, and all that may belong to it in the same window.  An order's state
    goes with its windows, which are four times the longer bound.
    """
    extras, order = seconds(extras_within) * 1000, seconds(order_within) * 1000
    wait = max(seconds(extras_within), seconds(order_within))
    core = max(1, 2 * wait)
    span = F.window("at", f"{core + 2 * wait} seconds", f"{core} seconds", f"{core - wait if wait else 0} seconds")
    ms, opens = F.unix_millis("at"), F.unix_millis("window.start") + wait * 1000
    timed = watermarked(parts, "at", delay).withColumn("window", span)
    own = (F.col("kind") != LINE) | ms.between(opens, opens + core * 1000 - 1)
    part = F.struct("kind", "line", "version", "payload", ms.alias("ms"))
    met = timed.where(own).groupBy("order_id", "window").agg(F.collect_list(part).alias("parts"))
    lines = met.select("order_id", "parts", F.explode(F.filter("parts", lambda p: p["kind"] == LINE)).alias("one"))

    def near(kind: str, bound: int) -> Column:
        return F.filter("parts", lambda p: (p["kind"] == kind) & (F.abs(p["ms"] - F.col("one.ms")) <= bound))

    def newest(kind: str) -> Column:
        own_parts = F.filter(near(kind, extras), lambda p: p["line"] == F.col("one.line"))
        return F.array_max(F.transform(own_parts, lambda p: F.struct(p["version"], p["payload"])))["payload"]

    joined = lines.select(
        "order_id", "one", newest(ACTIVITY).alias("activity"), newest(COUPON).alias("coupon"), F.explode(near(ORDER, order)).alias("version")
    )
    return joined.select(
        "order_id",
        F.col("one.payload").alias("line"),
        F.col("one.ms").alias("line_ms"),
        "activity",
        "coupon",
        F.col("version.payload").alias("order"),
        F.col("version.ms").alias("order_ms"),
    )
