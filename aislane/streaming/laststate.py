"""The previous message of every vessel, kept as Spark's own keyed state."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import timedelta
from operator import itemgetter

from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

# The processor runs in Python workers; it travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A gap this long begins a track of its own, of which the latest are kept for each vessel.
GAP = timedelta(days=1)
TRACKS = 4


class PreviousMessage(StatefulProcessor):
    """Gives every row its vessel's previous slot and speed, from the batch or from the state.

    The state is the last row of a vessel's latest tracks, a few rows whatever it sends. A message whose clock is far ahead
    begins a track of its own, so the others go on from where they were. A message that lies before its track's last one comes too late: its
    successor has been checked already, so it is passed over. ``keep_days`` is the state's time to live after the vessel's last batch, by the
    clock of the machines.
    """

    def __init__(self, columns: Sequence[str], schema: str, order: Sequence[str], keep_days: int | None = None):
        self.columns, self.schema, self.order = list(columns), schema, list(order)
        self.keep_ms = None if keep_days is None else keep_days * 86_400_000

    def init(self, handle) -> None:
        self.tracks = handle.getListState("tracks", self.schema, self.keep_ms)
        self.made = Row(*self.columns, "prev_slot", "prev_sog")
        self.time, self.slot, self.speed = (self.columns.index(c) for c in (self.order[0], "slot_num", "sog"))
        self.places = [self.columns.index(c) for c in self.order]

    def place(self, row: tuple) -> tuple:
        """Sorts as the batch check does: ascending, without a value last."""
        return tuple([(True, 0) if row[i] is None else (False, row[i]) for i in self.places])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        made, time, slot, speed = self.made, self.time, self.slot, self.speed
        last = [(self.place(row), row) for row in map(tuple, self.tracks.get())]
        batch, members = [], None
        for row in rows:
            # Rows of one group have their members in one order, which is looked up once.
            members = members or itemgetter(*[row.__fields__.index(c) for c in self.columns])
            values = members(row)
            batch.append((self.place(values), values))
        batch.sort(key=itemgetter(0))
        for placed in batch:
            place, row = placed
            before = ahead = None
            for track in last:
                if track[0] > place:
                    if ahead is None or track[0] < ahead[0]:
                        ahead = track
                elif before is None or track[0] > before[0]:
                    before = track
            if ahead is not None and ahead[1][time] - row[time] <= GAP:
                continue
            if before is None:
                yield made(*row, None, None)
            else:
                yield made(*row, before[1][slot], before[1][speed])
                if row[time] - before[1][time] <= GAP:
                    last.remove(before)
            last = [*last, placed][-TRACKS:]
        self.tracks.put([row for _, row in last])

    def close(self) -> None:
        pass
