"""State of the bigram stream: the calls of one pod in one window as sorted runs, merged when the window closes."""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "pod string, start_ms long, bigram string, n long, rank int"


class TopBigrams(StatefulProcessor):
    """Keyed by (pod, end of the window in ms); rows have micros, event_id and syscall.

    Calls come in any order. Each batch of them is sorted and kept as a run of blocks, one map entry per block, so no
    value of the state and no list grows with the pod. The timer at the window's end merges the runs block by block:
    what is held is one block per run, the previous call and one count per different bigram.
    """

    def __init__(self, window_ms: int, k: int, block_calls: int):
        self.window_ms, self.k, self.block_calls = window_ms, k, block_calls

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "n int")
        self.blocks = handle.getMapState("blocks", "run int, block int", "calls string, last boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs = self.runs.get()[0] if self.runs.exists() else 0
        if not runs:
            self.handle.registerTimer(int(key[1]))
        for frame in rows:
            ids = frame["event_id"].astype(object).where(frame["event_id"].notna(), None)
            calls = sorted(zip(frame["micros"].tolist(), ids, frame["syscall"]), key=_in_order)
            for start in range(0, len(calls), self.block_calls):
                block = calls[start:start + self.block_calls]
                self.blocks.updateValue((runs, start // self.block_calls), (json.dumps(block), start + self.block_calls >= len(calls)))
            runs += bool(calls)
        self.runs.update((runs,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        counts: dict[str, int] = {}
        previous = None
        for _, _, call in heapq.merge(*map(self._run, range(self.runs.get()[0])), key=_in_order):
            if previous is not None:
                bigram = f"{previous}_{call}"
                counts[bigram] = counts.get(bigram, 0) + 1
            previous = call
        self.runs.clear()
        self.blocks.clear()
        # calls came in order, so the dictionary holds bigrams by their first occurrence, which a stable sort keeps for ties
        top = sorted(counts.items(), key=lambda entry: -entry[1])[:self.k]
        if top:
            yield pd.DataFrame({"pod": key[0], "start_ms": int(key[1]) - self.window_ms, "bigram": [b for b, _ in top],
                                "n": [n for _, n in top], "rank": range(1, len(top) + 1)})

    def _run(self, run: int) -> Iterator[list]:
        block, last = 0, False
        while not last:
            calls, last = self.blocks.getValue((run, block))
            yield from json.loads(calls)
            block += 1

    def close(self) -> None:
        pass


def _in_order(call) -> tuple:
    """Batch order: time, then event id with null first."""
    micros, event_id, syscall = call
    return micros, event_id is not None, event_id or "", syscall


# Spark asks the processor for its state variables in a process beside the driver that doesn't get the shipped package,
# so the processor travels with its code
cloudpickle.register_pickle_by_value(sys.modules[__name__])
