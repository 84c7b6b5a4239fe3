"""Keyed state machines for what built-in stream operators cannot express.

Shipped to the workers by value, so the package need not be installed there. A processor sees the
records of one key in one micro-batch; how many that can be is bounded by the source's limit per
trigger. None of them keeps records longer than its result needs.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor


def in_order(row: Row, order: list[str]) -> tuple:
    """A key to sort rows by, nulls first as the batch forms have them."""
    return tuple((row[c] is not None, 0 if row[c] is None else row[c]) for c in order)


class NewFlag(StatefulProcessor):
    """Only the earliest record flagged new keeps the flag; the key is remembered (for a TTL).

    Records pass through one by one; of a new key only the earliest so far is held back.
    """

    def __init__(self, flag: str, order: list[str], new: str, old: str, ttl_ms: int | None):
        self.flag, self.order, self.new, self.old, self.ttl_ms = flag, order, new, old, ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen BOOLEAN", self.ttl_ms)

    def _with(self, row: Row, value: str) -> Row:
        return Row(**{**row.asDict(recursive=False), self.flag: value})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.seen.exists()
        best, best_at = None, None
        for row in rows:
            if row[self.flag] != self.new:
                yield row
            elif known:
                yield self._with(row, self.old)
            else:
                at = in_order(row, self.order)
                if best is None or at < best_at:
                    best, best_at, row = row, at, best
                if row is not None:
                    yield self._with(row, self.old)
        if best is not None:
            self.seen.update((True,))
            yield self._with(best, self.new)

    def close(self) -> None:
        pass


class Running(StatefulProcessor):
    """Running sums per key: each record leaves with the sums up to and including itself.

    The records of one micro-batch are put into time order first.
    """

    def __init__(self, order: list[str], values: list[str], names: list[str]):
        self.order, self.values, self.names = order, values, names

    def init(self, handle) -> None:
        fields = ", ".join(f"s{i} BIGINT" for i in range(len(self.names)))
        self.sums = handle.getValueState("sums", fields)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        sums = list(self.sums.get()) if self.sums.exists() else [0] * len(self.names)
        for row in sorted(rows, key=lambda r: in_order(r, self.order)):
            fields = row.asDict(recursive=False)
            for i, column in enumerate(self.values):
                sums[i] += fields.pop(column) or 0
            yield Row(**fields, **dict(zip(self.names, sums)))
        self.sums.update(tuple(sums))

    def close(self) -> None:
        pass


class EntryPattern(StatefulProcessor):
    """Entry records left without a following non-entry record within the horizon.

    One processor sees the records of many keys, so that calls to the state store are made for a
    bucket of keys and not for a record. Waiting records are kept, as one value, until the watermark
    has passed the successor, or the horizon where there is none; then they are decided and dropped.
    One timer per bucket is enough: it is set to the next moment at which a decision can fall.
    """

    def __init__(self, columns: list[str], lead: int, horizon_us: int):
        # records have ``lead`` other columns before their time, tie-break, entry, whether the record
        # belongs to this cell, key, and the columns
        self.columns, self.lead, self.horizon_us = columns, lead, horizon_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "records BINARY")

    def _held(self) -> list[tuple]:
        return pickle.loads(self.waiting.get()[0]) if self.waiting.exists() else []

    def _keep(self, records: list[tuple], due_us: int, timerValues) -> None:
        self.waiting.update((pickle.dumps(records),))
        self.handle.registerTimer(max(due_us // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = [tuple(r)[self.lead :] for r in rows]
        fresh = [r for r in fresh if r[0] is not None]  # no place in time, no pattern
        if not fresh:
            return
        # The first decision can fall just after the earliest record.
        self._keep(self._held() + fresh, min(r[0] for r in fresh), timerValues)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark_us = timerValues.getCurrentWatermarkInMs() * 1000
        by_key: dict = {}
        for row in self._held():
            plain = row[4] is None or isinstance(row[4], str | int)
            by_key.setdefault(row[4] if plain else repr(row[4]), []).append(row)
        rest, due = [], []
        for own in by_key.values():
            own.sort(key=lambda r: (r[0], r[1] is not None, r[1] or 0))
            keep_from = len(own)
            for i, row in enumerate(own):
                after = own[i + 1] if i + 1 < len(own) else None
                deadline = row[0] + self.horizon_us
                if after is not None and after[0] < deadline:
                    if after[0] > mark_us:
                        keep_from = i
                        break
                    how = "match" if after[2] else None
                elif deadline > mark_us:
                    keep_from = i
                    break
                else:
                    how = "timeout"
                if how and row[2] and row[3]:
                    yield Row(**dict(zip(self.columns, row[5:])), how=how)
            if keep_from < len(own):
                follower = own[keep_from + 1][0] if keep_from + 1 < len(own) else None
                deadline = own[keep_from][0] + self.horizon_us
                due.append(deadline if follower is None else min(follower, deadline))
                rest += own[keep_from:]
        if rest:
            self._keep(rest, min(due), timerValues)
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass
