"""Counts of many monitor paths in one read of the passes.

All paths form one automaton: its states are the distinct path prefixes, and
after each pass it is in the longest prefix that ends there. Every prefix that
ends at a pass is that state or a suffix of it, so the visits of the states are
all that has to be counted, whatever the number of paths.

The state depends on the last L monitors only (L: the longest path), so a
track can be cut anywhere. In a slice of a track (see ``slices``) all passes but
the first L - 1 are counted where the slice is. Those few go with the slice's
last L - 1 monitors to the car's other slices, and are counted behind the
monitors before them. So each pass is counted once, and what meets per car are
L - 1 monitors from each end of a slice.

The automaton is built on the driver; its size is that of the paths.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.functions.numbers import half_up_ratio
from roadlens.operators.slices import SLICE_ORDER, track_slices

ROOT = 0


class PathAutomaton:
    """States, moves and suffixes of a set of paths (lists of monitor ids)."""

    def __init__(self, paths: dict[str, list[str]]):
        if not paths or not all(paths.values()):
            raise ValueError("each path needs at least one monitor")
        self.monitors = sorted({m for path in paths.values() for m in path})
        self.longest = max(map(len, paths.values()))
        symbol = {m: i for i, m in enumerate(self.monitors, 1)}  # 0: any other monitor
        children: list[dict[int, int]] = [{}]
        self.prefixes = []  # (path, step, text, state)
        for name, path in paths.items():
            state = ROOT
            for step, monitor in enumerate(path, 1):
                if symbol[monitor] not in children[state]:
                    children.append({})
                    children[state][symbol[monitor]] = len(children) - 1
                state = children[state][symbol[monitor]]
                self.prefixes.append((name, step, ",".join(path[:step]), state))
        width = len(symbol) + 1
        suffix = [ROOT] * len(children)
        self.moves = [ROOT] * (len(children) * width)
        todo = deque([ROOT])
        while todo:  # breadth first: a state's longest proper suffix is shorter than it
            state = todo.popleft()
            for s in range(1, width):
                elsewhere = self.moves[suffix[state] * width + s] if state != ROOT else ROOT
                child = children[state].get(s)
                self.moves[state * width + s] = elsewhere if child is None else child
                if child is not None:
                    suffix[child] = elsewhere
                    todo.append(child)
        self.endings = []  # (state, each prefix that ends where it does)
        for state in range(1, len(children)):
            at = state
            while at != ROOT:
                self.endings.append((state, at))
                at = suffix[at]

    def symbol(self, monitor: Column) -> Column:
        return F.coalesce(F.array_position(F.lit(self.monitors), monitor), F.lit(0)).cast("int")

    def state(self, symbols: Column) -> Column:
        """State after the array ``symbols``, from the root."""
        width = len(self.monitors) + 1
        # one constant, however many states there are
        moves = F.split(F.lit(",".join(map(str, self.moves))), ",").cast("array<int>")
        return F.aggregate(symbols, F.lit(ROOT), lambda at, s: F.get(moves, at * width + s))


def _visits(automaton: PathAutomaton, steps: Column, first: Column, last: Column) -> Column:
    """``state, n`` after each of ``steps`` (symbol, n) from index ``first`` to ``last``, but for the root."""
    def visit(i: Column) -> Column:
        low = F.greatest(i - automaton.longest + 1, F.lit(0))
        return F.struct(automaton.state(F.slice(steps, low + 1, i - low + 1)["symbol"]).alias("state"),
                        F.get(steps, i)["n"].alias("n"))

    at = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    on_paths = F.filter(at, lambda i: F.get(steps, i)["symbol"] != 0)  # any other monitor leads to the root
    return F.filter(F.transform(on_paths, visit), lambda v: v["state"] != ROOT)


def state_visits(flow: DataFrame, automaton: PathAutomaton) -> DataFrame:
    """``state, n``: how often the cars' tracks are in each state."""
    longest = automaton.longest

    def repeat(run: Column) -> Column:
        # after `longest` equal monitors the state stays: the last one stands for the rest
        times = F.least(run["n"], F.lit(longest)).cast("int")
        return F.transform(F.sequence(F.lit(1), times), lambda i: F.struct(
            run["label"].alias("symbol"), F.when(i == times, run["n"] - times + 1).otherwise(1).alias("n")))

    slices = track_slices(flow, automaton.symbol(F.col("monitor_id")))
    slices = slices.withColumn("steps", F.flatten(F.transform("runs", repeat)))
    inner = slices.select(F.inline(_visits(automaton, F.col("steps"), F.lit(longest - 1), F.size("steps") - 1)))
    if longest == 1:
        return inner.groupBy("state").agg(F.sum("n").alias("n"))
    ends = slices.select("car", *SLICE_ORDER, F.slice("steps", 1, longest - 1).alias("head"),
                         F.slice("steps", F.greatest(F.size("steps") - longest + 2, F.lit(1)), longest - 1).alias("tail"))
    before = Window.partitionBy("car").orderBy(*SLICE_ORDER).rowsBetween(-(longest - 1), -1)
    earlier = F.flatten(F.collect_list("tail").over(before))
    seams = (ends.select("head", earlier.alias("earlier"))
             .withColumn("earlier", F.slice("earlier", F.greatest(F.size("earlier") - longest + 2, F.lit(1)), longest - 1))
             .select(F.concat("earlier", "head").alias("steps"), F.size("earlier").alias("first")))
    outer = seams.select(F.inline(_visits(automaton, F.col("steps"), F.col("first"), F.size("steps") - 1)))
    return inner.unionByName(outer).groupBy("state").agg(F.sum("n").alias("n"))


def many_path_counts(flow: DataFrame, paths: dict[str, list[str]]) -> DataFrame:
    """Occurrences of every prefix of every path as a contiguous run in the cars' tracks.

    ``path_id, step, path`` (the prefix), ``cnt`` (overlapping runs count
    separately) and ``prev_cnt`` (the step before, null for step 1). Monitors
    match by whole id; passes at other monitors, or at none, break a run.
    Paths may share prefixes, repeat monitors and have any length.
    """
    spark, automaton = flow.sparkSession, PathAutomaton(paths)
    ends_in: dict[int, list[int]] = {}
    for state, prefix in automaton.endings:
        ends_in.setdefault(prefix, []).append(state)
    state_of = {(name, step): state for name, step, _, state in automaton.prefixes}
    rows = [(state, name, step, text, now) for name, step, text, _ in automaton.prefixes
            for now in (True, False) if now or step > 1
            for state in ends_in[state_of[name, step - (not now)]]]
    # both tables have as many rows as the paths have prefixes, times their suffixes
    steps = spark.createDataFrame(rows, "state int, path_id string, step int, path string, now boolean")
    zeros = spark.createDataFrame([p[:3] for p in automaton.prefixes], "path_id string, step int, path string")
    seen = (state_visits(flow, automaton).join(F.broadcast(steps), "state")
            .select("path_id", "step", "path", F.when(F.col("now"), F.col("n")).otherwise(0).alias("cnt"),
                    F.when(F.col("now"), 0).otherwise(F.col("n")).alias("prev_cnt")))
    zero = F.lit(0).cast("long")
    return (zeros.withColumns({"cnt": zero, "prev_cnt": zero}).unionByName(seen)
            .groupBy("path_id", "step", "path")
            .agg(F.sum("cnt").alias("cnt"), F.sum("prev_cnt").alias("prev_cnt"))
            .withColumn("prev_cnt", F.when(F.col("step") > 1, F.col("prev_cnt"))))


def many_path_conversion(flow: DataFrame, paths: dict[str, list[str]]) -> DataFrame:
    """Step conversion rates of many paths: the steps after the first that occur, ``rate = cnt / prev_cnt``."""
    return (many_path_counts(flow, paths).filter((F.col("step") >= 2) & (F.col("cnt") > 0))
            .withColumn("rate", half_up_ratio("cnt", "prev_cnt", 2)))
