"""Problem 7: filling fixed-capacity containers with items.

Only the histogram of item sizes reaches the driver; its length is bounded by
the capacity, not by the data.  Large sizes are rounded up to a fine step, and
the shallow combinations (up to three sizes) that fill a window below the
capacity are enumerated.  Non-negative least squares finds how often each is
used against the histogram; the counts are rounded down.  What is left, and all
small items, is packed greedily, best fit first, on runs of equal containers.

The plan is a list of patterns with counts.  Items get their rank within their
size in parallel (a hash bucket's offset plus the rank inside the bucket, so a
size that a third of all items share is no single task's group) and find their
container in the plan by that rank.

Defined results: items of size 0 (empty texts) go nowhere; an item above the
capacity fills containers of its own, its remainder is packed as an item; equal
sizes are told apart by a hash and the id; an empty table gives no containers.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packetloom.session import cut, maybe_broadcast, small_rows

STEPS, SMALL, WINDOW_STEPS, MAX_COMBINATIONS, MAX_KINDS = 256, 8, 1, 20_000, 10_000
#: Items a hash bucket when ranks are counted.
BUCKET_ROWS = 50_000
Pattern = tuple[tuple[int, int], ...]  # ((size, how many), ...)


def step_of(capacity: int) -> int:
    return max(1, capacity // STEPS)


def planned_size(size: int, capacity: int) -> int:
    """Small sizes exactly, large ones rounded up to the step."""
    step = step_of(capacity)
    return size if size * SMALL < capacity else min(capacity, -(-size // step) * step)


def combinations_filling(sizes: list[int], capacity: int, window: int, limit: int = MAX_COMBINATIONS) -> list[tuple[int, ...]]:
    """Up to three sizes whose sum lies in [capacity - window, capacity], closest fills first.

    The steps of the planned sizes bound their number; more than ``limit`` means
    that the sizes are no planned ones.
    """
    low, present = capacity - window, np.array(sorted(sizes))
    out = [(s,) for s in sizes if s >= low]
    for a, b in combinations_with_replacement(sorted(sizes), 2):
        if low <= a + b <= capacity:
            out.append((a, b))
        i, j = np.searchsorted(present, [max(b, low - a - b), capacity - a - b + 1])
        out += [(a, b, int(c)) for c in present[i:j]]
    if len(out) > limit:
        raise ValueError(f"{len(out)} combinations fill the window, more than {limit}")
    return sorted(out, key=lambda c: (capacity - sum(c), len(c), c))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    gradient = a.T @ b
    scale = tolerance * max(1.0, float(np.abs(gradient).max(initial=0)))
    for _ in range(3 * a.shape[0] + 10):
        free = np.where(active, -np.inf, gradient)
        k = int(free.argmax()) if n else 0
        if not n or free[k] <= scale:
            break
        active[k] = True
        while True:
            idx = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[idx] = s
                break
            bad = s <= 0
            ratio = x[idx][bad] / np.maximum(x[idx][bad] - s[bad], 1e-300)
            x[idx] += ratio.min() * (s - x[idx])
            active &= x > scale / max(1.0, scale)  * 1e-12
            x[~active] = 0
            if not active.any():
                break
        gradient = a.T @ (b - a @ x)
    return x


def shallow_plan(histogram: dict[int, int], capacity: int) -> tuple[dict[Pattern, int], dict[int, int]]:
    """(patterns with counts, what is left of the histogram) for the large sizes."""
    large = [s for s in histogram if s * SMALL >= capacity]
    combos = combinations_filling(large, capacity, WINDOW_STEPS * step_of(capacity))
    left = dict(histogram)
    if not combos:
        return {}, left
    row = {s: i for i, s in enumerate(sorted(large))}
    matrix = np.zeros((len(row), len(combos)))
    for j, combo in enumerate(combos):
        for s in combo:
            matrix[row[s], j] += 1
    counts = nonnegative_least_squares(matrix, np.array([histogram[s] for s in sorted(large)], float))
    plan: dict[Pattern, int] = {}
    for j in np.argsort(-counts, kind="stable"):
        pattern = tuple(sorted((s, combos[j].count(s)) for s in set(combos[j])))
        times = min([int(counts[j] + 1e-6), *(left[s] // m for s, m in pattern)])
        if times > 0:
            plan[pattern] = plan.get(pattern, 0) + times
            for s, m in pattern:
                left[s] -= m * times
    return plan, {s: n for s, n in left.items() if n}


def greedy_plan(plan: dict[Pattern, int], left: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Best fit, largest sizes first, on runs of containers with equal contents."""
    room: dict[int, dict[Pattern, int]] = defaultdict(dict)

    def put(pattern: Pattern, times: int) -> None:
        free = capacity - sum(s * m for s, m in pattern)
        room[free][pattern] = room[free].get(pattern, 0) + times

    def add(pattern: Pattern, size: int, times: int) -> Pattern:
        have = dict(pattern)
        have[size] = have.get(size, 0) + times
        return tuple(sorted(have.items()))

    for pattern, times in plan.items():
        put(pattern, times)
    for size in sorted(left, reverse=True):
        n = left[size]
        for free in sorted(f for f in room if f >= size):
            each = free // size
            for pattern in list(room[free]):
                if n <= 0:
                    break
                have = room[free].pop(pattern)
                full = min(have, n // each)
                if full:
                    put(add(pattern, size, each), full)
                n -= full * each
                have -= full
                if have and n:  # the last, partly filled one
                    put(add(pattern, size, min(n, each)), 1)
                    n -= min(n, each)
                    have -= 1
                if have:
                    room[free][pattern] = have
            if not room[free]:
                del room[free]
            if n <= 0:
                break
        each = capacity // size
        if n // each:
            put(((size, each),), n // each)
        if n % each:
            put(((size, n % each),), 1)
    return {p: n for groups in room.values() for p, n in groups.items()}


def plan_for(histogram: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Patterns with counts that hold every item of the histogram (of planned sizes)."""
    return greedy_plan(*shallow_plan(histogram, capacity), capacity)


def plan_rows(plan: dict[Pattern, int]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, end rank, first container, items a container) of every run of slots."""
    rows, used, container = [], defaultdict(int), 0
    for pattern, times in sorted(plan.items()):
        for size, m in pattern:
            rows.append((size, used[size], used[size] + m * times, container, m))
            used[size] += m * times
        container += times
    return rows


def ranked(items: DataFrame, keys: list[str], order: list[str], buckets: int) -> DataFrame:
    """``items`` with ``rank`` (from 0) within ``keys``: bucket offsets plus ranks inside hash buckets.

    ``buckets`` should grow with the rows of the largest key.
    """
    bucketed = items.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    return bucketed.withColumn("__in", F.row_number().over(inside) - 1).join(offsets, [*keys, "__bucket"]).withColumn("rank", F.col("__in") + F.col("__offset")).drop("__bucket", "__in", "__offset")


def fill_containers(sized: DataFrame, capacities: DataFrame, max_capacity: int = 1 << 16) -> DataFrame:
    """container_kind, container_no, doc_id, part, n_tokens: every item (doc_id, n_tokens) in a container of each kind.

    ``capacities``: container_kind, capacity_tokens; a short list whose
    capacities are at most ``max_capacity``, which bounds the plan.
    """
    listed = small_rows(capacities.select("container_kind", "capacity_tokens").distinct(), MAX_KINDS)
    if listed is None:
        raise ValueError(f"more than {MAX_KINDS} kinds of containers")
    kinds = {r["container_kind"]: int(r["capacity_tokens"]) for r in listed}
    if len(kinds) < len(listed):
        raise ValueError("a kind of container has two capacities")
    if any(not 0 < c <= max_capacity for c in kinds.values()):
        raise ValueError("a capacity is not between 1 and max_capacity")
    spark = sized.sparkSession
    if not kinds:
        kinds = {"": 1}
        sized = sized.limit(0)
    each_kind = F.array(*(F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("long").alias("capacity")) for k, c in sorted(kinds.items())))
    items = sized.where(F.col("n_tokens") > 0).select("doc_id", "n_tokens", F.inline(each_kind))  # every item goes into a container of each kind
    whole, rest = F.floor(F.col("n_tokens") / F.col("capacity")), F.col("n_tokens") % F.col("capacity")
    n_parts = whole + (rest > 0).cast("long")
    parts = items.select("container_kind", "capacity", "doc_id", rest.alias("__rest"), F.explode(F.sequence(F.lit(1).cast("long"), n_parts)).alias("part"), n_parts.alias("__parts"))
    size = F.when((F.col("part") == F.col("__parts")) & (F.col("__rest") > 0), F.col("__rest")).otherwise(F.col("capacity"))
    parts = parts.select("container_kind", "capacity", "doc_id", F.col("part").cast("int").alias("part"), size.alias("n_tokens"))
    step = F.greatest(F.lit(1), F.floor(F.col("capacity") / STEPS))
    planned = F.when(F.col("n_tokens") * SMALL < F.col("capacity"), F.col("n_tokens")).otherwise(F.least("capacity", F.ceil(F.col("n_tokens") / step) * step))
    parts = cut(parts.withColumn("size", planned))
    histogram = defaultdict(dict)
    for r in parts.groupBy("container_kind", "size").agg(F.count(F.lit(1)).alias("n")).collect():  # at most capacity rows a kind
        histogram[r["container_kind"]][int(r["size"])] = r["n"]
    rows = [(kind, *row) for kind, sizes in histogram.items() for row in plan_rows(plan_for(sizes, kinds[kind]))]
    # slots of one size are ordered by rank: an equal key with a range is an as-of lookup in a sorted array
    plan = spark.createDataFrame(rows, "container_kind string, size long, first long, end long, container long, each long")
    runs = plan.groupBy("container_kind", "size").agg(F.array_sort(F.collect_list(F.struct("first", "end", "container", "each"))).alias("runs"))
    most = max((n for sizes in histogram.values() for n in sizes.values()), default=0)
    placed = ranked(parts, ["container_kind", "size"], ["doc_id", "part"], max(16, -(-most // BUCKET_ROWS))).join(maybe_broadcast(runs), ["container_kind", "size"])
    run = F.element_at(F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["end"])), 1)
    placed = placed.withColumn("run", run)
    number = F.col("run.container") + F.floor((F.col("rank") - F.col("run.first")) / F.col("run.each"))
    return placed.select("container_kind", "capacity", number.alias("container_no"), "doc_id", "part", "n_tokens")
