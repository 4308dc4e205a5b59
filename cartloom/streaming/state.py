"""Stateful processors. State is per key and leaves through an event-time timer.

Each one grades a key's rows in event order (``judge``). Without ``slot_us`` a micro-batch's rows are graded as they arrive,
ordered among themselves. With it they wait in state, in slots of event time, and a slot is graded when the watermark passes
its end: the result then depends on event times alone, not on how rows were dealt to micro-batches.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cartloom.operators.events import grade_hits


def _ordered(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """One key's rows in event order: those of a micro-batch (bounded by its admission limit) or of one slot."""
    return pd.concat(list(rows), ignore_index=True).sort_values(["us", "seq"], kind="stable", ignore_index=True)


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(data)).read_pandas()


class _Timed(StatefulProcessor):
    """Base: the key's end moves with its latest event; everything is cleared when that timer fires.

    ``carry`` names input columns that go through to the output.
    """

    def __init__(self, keep_us: int, slot_us: int = 0, carry: tuple[str, ...] = ()) -> None:
        if slot_us % 1000 or slot_us > keep_us:
            raise ValueError("a slot is whole milliseconds and no longer than the time a key is kept")
        self.keep_us, self.slot_us, self.carry = keep_us, slot_us, carry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint")
        if self.slot_us:
            self.slots = handle.getMapState("slots", "slot bigint", "parts int")
            self.parts = handle.getMapState("parts", "slot bigint, part int", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.slot_us:
            yield self.verdicts(_ordered(rows))
            return
        for chunk in rows:  # one Arrow batch at a time
            kept = chunk.drop(columns=["key", "ts"], errors="ignore")
            for slot, part in kept.groupby(kept["us"] // self.slot_us, sort=False):
                self.hold(int(slot), part)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if self.slot_us and at * 1000 % self.slot_us == 0 and self.waits(at * 1000 // self.slot_us - 1):
            yield self.verdicts(self.release(at * 1000 // self.slot_us - 1))
            return
        # a slot around the key's end may hold events from before it, and will move the end when it is graded
        if self.last.exists() and self.end(self.last.get()[0]) == at and not (self.slot_us and self.waits(at * 1000 // self.slot_us)):
            self.forget()
            self.last.clear()
        yield pd.DataFrame()

    def hold(self, slot: int, rows: pd.DataFrame) -> None:
        """Adds a part to a slot; nothing that waits is read or written again."""
        n = self.slots.getValue((slot,))[0] if self.waits(slot) else 0
        if not n:
            self.handle.registerTimer((slot + 1) * self.slot_us // 1000)
        self.parts.updateValue((slot, n), (_packed(rows),))
        self.slots.updateValue((slot,), (n + 1,))

    def waits(self, slot: int) -> bool:
        return self.slots.containsKey((slot,))

    def release(self, slot: int) -> pd.DataFrame:
        keys = [(slot, part) for part in range(self.slots.getValue((slot,))[0])]
        rows = _ordered(_unpacked(self.parts.getValue(k)[0]) for k in keys)
        for k in keys:
            self.parts.removeKey(k)
        self.slots.removeKey((slot,))
        return rows

    def end(self, us: int) -> int:
        return int((us + self.keep_us) // 1000 + 1)

    def touch(self, us: int) -> None:
        """Moves the key's end; a slot's timer at the same time stays."""
        if self.last.exists():
            old = self.end(self.last.get()[0])
            slot_end = self.slot_us and old * 1000 % self.slot_us == 0 and self.waits(old * 1000 // self.slot_us - 1)
            if old != self.end(us) and not slot_end:
                self.handle.deleteTimer(old)
        self.last.update((int(us),))
        self.handle.registerTimer(self.end(us))

    def verdicts(self, batch: pd.DataFrame) -> pd.DataFrame:
        carried = {c: batch[c] for c in self.carry}
        return pd.DataFrame({"seq": batch["seq"], "us": batch["us"], **self.judge(batch), **carried})

    def judge(self, batch: pd.DataFrame) -> dict[str, object]:
        raise NotImplementedError

    def forget(self) -> None:
        pass

    def close(self) -> None:
        pass


class SeenDeliveries(_Timed):
    """Marks a delivery id seen within the TTL; each arrival restarts it."""

    def judge(self, batch: pd.DataFrame) -> dict[str, object]:
        times = batch["us"].to_numpy()
        before = self.last.get()[0] if self.last.exists() else None
        previous = np.concatenate([[before if before is not None else times[0] - self.keep_us], times[:-1]])
        self.touch(times[-1])
        return {"duplicate": times - previous < self.keep_us}


class LastPath(_Timed):
    """Marks a view whose path differs from the session's previous one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.path = handle.getValueState("path", "path string")

    def judge(self, batch: pd.DataFrame) -> dict[str, object]:
        paths = [None if pd.isna(p) else p for p in batch["path"]]
        known = self.path.exists()
        earlier = [self.path.get()[0] if known else None, *paths[:-1]]
        send = [a != b for a, b in zip(earlier, paths)]
        send[0] = send[0] or not known
        self.path.update((paths[-1],))
        self.touch(batch["us"].iloc[-1])
        return {"send": send}

    def forget(self) -> None:
        self.path.clear()


class SlidingLog(_Timed):
    """Accepted times of a key within the window; denied hits are not recorded."""

    def __init__(self, limit: int, window_us: int, slot_us: int = 0, carry: tuple[str, ...] = ()) -> None:
        super().__init__(window_us, slot_us, carry)
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.log = handle.getListState("accepted", "us bigint")

    def judge(self, batch: pd.DataFrame) -> dict[str, object]:
        times = batch["us"].to_numpy()
        kept = deque(r[0] for r in self.log.get())
        left, wait = grade_hits(times, kept, self.limit, self.keep_us)
        self.log.put([(int(t),) for t in kept])
        self.touch(times[-1])
        return {"allowed": left >= 0, "remaining": np.maximum(left, 0), "wait_us": wait}

    def forget(self) -> None:
        self.log.clear()
