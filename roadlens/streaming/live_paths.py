"""Live path counts: keyed state per plate, event-time timers.

Passes come late and out of order, so a plate's passes wait in its state until
the watermark has passed them; then they are taken in the plate's order (time,
text, monitor, camera, id), behind the last L - 1 monitors taken before (L: the
longest path). Each step emits what it adds to the prefixes' counts, so the
sums over all output are the counts of the batch operator for the passes
before the watermark. A timer per plate wakes it when its earliest waiting
pass is due. Passes later than the watermark are dropped, and repeated ones
(a file that arrives twice) are dropped by their id.

State per plate: passes younger than the watermark delay, and L - 1 monitors.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadlens.functions.dates import lenient_seconds
from roadlens.operators.common import legal_cars
from roadlens.operators.paths import ROOT, PathAutomaton
from roadlens.schema import TIEBREAK_COLUMN

_ORDER = ["t", "action_time", "monitor_id", "camera_id", TIEBREAK_COLUMN]
_WAITING = "array<struct<t:bigint,action_time:string,monitor_id:string,camera_id:string,event_id:bigint>>"


def _matcher(automaton: PathAutomaton):
    """The state function of one plate."""
    symbols = {m: i for i, m in enumerate(automaton.monitors, 1)}
    width, keep, moves = len(automaton.monitors) + 1, automaton.longest - 1, automaton.moves
    prefixes_of: dict[int, list[tuple[str, int]]] = {}  # that end in a state
    names: dict[int, list[tuple[str, int]]] = {}
    for path, step, _, state in automaton.prefixes:
        names.setdefault(state, []).append((path, step))
    for state, prefix in automaton.endings:
        prefixes_of.setdefault(state, []).extend(names[prefix])

    def run(key, batches, state: GroupState):
        waiting, tail = state.get if state.exists else ([], [])
        rows = [tuple(r) for r in waiting]
        if not state.hasTimedOut:
            for batch in batches:
                rows += list(batch[_ORDER].astype(object).where(batch[_ORDER].notna(), None).itertuples(index=False, name=None))
        rows.sort(key=lambda r: (r[0], *[(x is not None, x if x is not None else "") for x in r[1:4]], r[4]))
        mark = state.getCurrentWatermarkMs()
        due = [r for r in rows if r[0] * 1000 < mark]
        rows = rows[len(due):]
        at, counts = ROOT, {}
        for s in tail:
            at = moves[at * width + s]
        for r in due:
            s = symbols.get(r[2], 0)
            at, tail = moves[at * width + s], (list(tail) + [s])[-keep:] if keep else []
            for prefix in prefixes_of.get(at, ()):
                counts[prefix] = counts.get(prefix, 0) + 1
        if rows or tail:
            state.update((rows, list(tail)))
            if rows:
                state.setTimeoutTimestamp(rows[0][0] * 1000 + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(p, i, n) for (p, i), n in counts.items()], columns=["path_id", "step", "cnt"])

    return run


def live_path_counts(passes: DataFrame, paths: dict[str, list[str]], watermark: str = "10 minutes") -> DataFrame:
    """``path_id, step, cnt``: increments of the prefixes' counts, as the watermark passes (append mode).

    ``passes`` is a stream of pass rows with a unique ``event_id``; those
    without a plate or a time that parses take no part.
    """
    timed = (legal_cars(passes).withColumn("t", lenient_seconds("action_time"))
             .filter(F.col("t").isNotNull() & F.col(TIEBREAK_COLUMN).isNotNull())
             .withColumn("event_ts", F.timestamp_seconds("t")).withWatermark("event_ts", watermark)
             .dropDuplicatesWithinWatermark([TIEBREAK_COLUMN])
             .select("car", "event_ts", *_ORDER))
    return timed.groupBy("car").applyInPandasWithState(
        _matcher(PathAutomaton(paths)), "path_id string, step int, cnt long",
        f"waiting {_WAITING}, tail array<int>", "append", GroupStateTimeout.EventTimeTimeout)
