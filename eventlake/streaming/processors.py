"""Stateful steps of the streams that no built-in operator takes.

Each is a `StatefulProcessor` behind aggregates in append mode. The aggregates take the load: they combine the events of a
window or an instant, wait for late ones and hand on what is closed, in order of the watermark. What arrives here is one row
per closed window, per closed instant of a user, or per finding, and the state of a key has a fixed size.

Times are microseconds since 1970; timers take milliseconds. The classes travel to the executors by value, so a
cluster needs nothing installed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def summary(values: list[float | None]) -> tuple[float | None, float | None, float | None, float | None]:
    """Mean, sample deviation, least and greatest of the values that are there."""
    known = [v for v in values if v is not None]
    if not known:
        return None, None, None, None
    mean = sum(known) / len(known)
    spread = (sum((v - mean) ** 2 for v in known) / (len(known) - 1)) ** 0.5 if len(known) > 1 else None
    return mean, spread, min(known), max(known)


def timer_after(micros: int) -> int:
    """The first millisecond that is not before an instant."""
    return -(-micros // 1000)


class WindowTimeline(StatefulProcessor):
    """Closed windows in order, silent ones filled in with zeros, each with the statistics of the windows before it.

    Silence is noticed in two ways: a later window shows the gap before it, and a timer at the end of the next window fires once the
    watermark has passed it, while the windows after the gap are still open.
    """

    def __init__(self, columns: dict[str, Any], measures: tuple[str, ...], width: int, windows: int):
        #: Columns of a window after its start, with their values in a silent one.
        self.silent = dict(columns)
        self.measures, self.width, self.windows = measures, width, windows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = ", ".join(f"{m} array<double>" for m in self.measures)
        self.state = handle.getValueState("timeline", f"last bigint, {lists}")

    def _load(self) -> tuple[int | None, list[list[float | None]]]:
        if not self.state.exists():
            return None, [[] for _ in self.measures]
        last, *lists = self.state.get()
        return last, [list(v) for v in lists]

    def _emit(self, start: int, values: dict[str, Any], lists: list[list[float | None]]) -> Row:
        based = {"baseline_windows": len(lists[0])}
        for name, known in zip(self.measures, lists):
            for part, value in zip(("mean", "std", "min", "max"), summary(known)):
                based[f"{name}_{part}"] = value
            value = values[name]
            known.append(None if value is None else float(value))
            del known[: -self.windows]
        return Row(start=start, **{c: values[c] for c in self.silent}, **based)

    def _keep(self, last: int, lists: list[list[float | None]], armed: int | None) -> None:
        self.state.update((last, *lists))
        if armed is not None:
            self.handle.deleteTimer(timer_after(armed + 2 * self.width))
        self.handle.registerTimer(timer_after(last + 2 * self.width))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        last, lists = self._load()
        armed = last
        for row in sorted(rows, key=lambda r: r.start):
            while last is not None and last + self.width < row.start:
                last += self.width
                yield self._emit(last, self.silent, lists)
            last = row.start
            yield self._emit(last, row.asDict(), lists)
        self._keep(last, lists, armed)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        last, lists = self._load()
        armed = last
        now = timerValues.getCurrentWatermarkInMs() * 1000
        while last + 2 * self.width <= now:
            last += self.width
            yield self._emit(last, self.silent, lists)
        if last != armed:
            self._keep(last, lists, None)

    def close(self) -> None:
        pass


class LogoutSessions(StatefulProcessor):
    """Closed instants of a user, joined into sessions that end with a logout or after a gap.

    The state is the open session. A session that ends with a logout is handed on as soon as that instant is closed.
    """

    SUMS = ("events", "views", "cart_adds", "purchases")

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        sums = ", ".join(f"{c} bigint" for c in self.SUMS)
        self.state = handle.getValueState("open", f"first bigint, last bigint, {sums}, revenue double")

    def _row(self, key: Any, session: list, logged_out: bool) -> Row:
        first, last, *sums, revenue = session
        return Row(user_id=key[0], first=first, last=last, **dict(zip(self.SUMS, sums)), revenue=revenue, logged_out=logged_out)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        session = list(self.state.get()) if self.state.exists() else None
        armed = session[1] if session else None
        for row in sorted(rows, key=lambda r: r.at):
            if session and row.at > session[1] + self.gap:
                yield self._row(key, session, False)
                session = None
            if session is None:
                session = [row.at, row.at, 0, 0, 0, 0, None]
            session[1] = row.at
            for i, name in enumerate(self.SUMS):
                session[2 + i] += row[name]
            if row.revenue is not None:
                session[6] = (session[6] or 0.0) + row.revenue
            if row.logout:
                yield self._row(key, session, True)
                session = None
        if armed is not None:
            self.handle.deleteTimer(timer_after(armed + self.gap))
        if session is None:
            self.state.clear()
        else:
            self.state.update(tuple(session))
            self.handle.registerTimer(timer_after(session[1] + self.gap))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.state.exists():
            session = list(self.state.get())
            if timer_after(session[1] + self.gap) <= expiredTimerInfo.getExpiryTimeInMs():
                yield self._row(key, session, False)
                self.state.clear()

    def close(self) -> None:
        pass


class FirstAlerts(StatefulProcessor):
    """Findings of a type, each with whether it is worth a message: it is severe enough, and none of its type was sent within the span before.

    The state is the window of the last message. It is dropped when the watermark has left the span behind, since then the next
    finding is sent anyway.
    """

    def __init__(self, span: int, severities: tuple[str, ...], columns: tuple[str, ...]):
        self.span, self.severities, self.columns = span, severities, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sent", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        sent = self.state.get()[0] if self.state.exists() else None
        before = sent
        for row in sorted(rows, key=lambda r: (r.at, str(tuple(r)))):
            worth = row.severity in self.severities and (sent is None or row.at >= sent + self.span)
            sent = row.at if worth else sent
            yield Row(at=row.at, **{c: row[c] for c in self.columns}, is_first=worth)
        if sent != before:
            self.state.update((sent,))
            self.handle.registerTimer(timer_after(sent + self.span))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.state.exists() and timer_after(self.state.get()[0] + self.span) <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass
