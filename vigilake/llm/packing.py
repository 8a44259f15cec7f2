"""Filling fixed-capacity containers with items, by bin completion.

A container is filled around the largest item left: the fillings of its residual capacity are enumerated, dominated ones are left
out (a filling is dominated if its items fit into the places of another's), and branch and bound tries the rest in order of waste. A
branch is cut when its waste so far exceeds what a solution with one container less than the incumbent may waste in all; the first
incumbent is best-fit decreasing, and the search of a group stops when it meets the volume bound or its node budget.

Only an item larger than the capacity is split: into full containers and one remainder, which is packed like any other.
The items are spread by hash over groups of bounded size, so no task holds more than about ``GROUP`` of them, however many there are and
however uneven; the containers each group leaves with room to spare are opened again and packed across groups in a second round.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.tables import cut, width

CAPACITY = 2048
GROUP = 4096
NODES = 6000
GROUPS_A_TASK = 16
OPEN = 32  # a container with more free tokens than this is packed again across groups
SCHEMA = "container long, position int, doc_id long, part int, tokens int"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each size into the fullest container with room."""
    rooms: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        at = bisect_left(rooms, (s, -1))
        if at == len(rooms):
            bins.append([s])
            insort(rooms, (capacity - s, len(bins) - 1))
        else:
            room, b = rooms.pop(at)
            bins[b].append(s)
            insort(rooms, (room - s, b))
    return bins


def _fits(items: list[int], places: list[int]) -> bool:
    """Whether ``items`` (descending) fit into ``places`` by best fit."""
    room = sorted(places)
    for s in items:
        at = bisect_left(room, s)
        if at == len(room):
            return False
        insort(room, room.pop(at) - s)
    return True


def fillings(room: int, sizes: list[int], left: Counter, scale: int = 1) -> tuple[list[list[int]], bool]:
    """(undominated fillings of ``room`` from the sizes left, least waste first; whether some were left out). ``sizes`` are ascending and distinct.

    Each filling is maximal. At ``scale`` 1 six sizes are tried a level, 240 nodes enumerated, the twelve fillings with least waste compared and four kept; every doubling of the scale doubles all four. The first
    filling that leaves nothing dominates every other and ends the enumeration.
    """
    out: list[tuple[int, list[int]]] = []
    nodes = 0
    chosen: list[int] = []
    used: Counter = Counter()
    short = False

    def walk(room: int, top: int) -> bool:
        nonlocal nodes, short
        nodes += 1
        at = min(bisect_right(sizes, room), top) - 1
        tried = 0
        while at >= 0:
            s = sizes[at]
            if left[s] > used[s]:
                if tried == 6 * scale or nodes >= 240 * scale:
                    short = True
                    break
                tried += 1
                used[s] += 1
                chosen.append(s)
                done = walk(room - s, at + 1)
                chosen.pop()
                used[s] -= 1
                if done:
                    return True
            at -= 1
        if not tried:
            out.append((room, chosen.copy()))
            return room == 0
        return False

    if walk(room, len(sizes)):
        return [min(out)[1]], False
    out.sort(key=lambda x: (x[0], len(x[1]), [-s for s in x[1]]))
    kept: list[list[int]] = []
    for _, items in out[: 12 * scale]:
        if not any(k == items or _fits(items, k) for k in kept):
            kept.append(items)
        if len(kept) == 4 * scale:
            break
    return kept, short or len(out) > 12 * scale or len(kept) == 4 * scale


def complete(sizes: list[int], capacity: int = CAPACITY, budget: int = NODES) -> list[list[int]]:
    """Containers (lists of sizes, all between 1 and ``capacity``) by bin completion.

    Where the search has tried all that the enumeration gave it and still lies above the volume bound, it starts again with twice the enumeration, as long as the node budget lasts and something was left out.
    """
    if not sizes:
        return []
    total, best = sum(sizes), best_fit(sizes, capacity)
    bound = math.ceil(total / capacity)
    nodes, scale = 0, 1
    while len(best) > bound and nodes < budget:
        best, used, short = _search(sizes, capacity, best, total, bound, budget - nodes, scale)
        nodes += used
        scale *= 2
        if not short:
            break
    return best


def _search(sizes: list[int], capacity: int, best: list[list[int]], total: int, bound: int, budget: int, scale: int) -> tuple[list[list[int]], int, bool]:
    """(best containers, nodes used, whether an enumeration left something out) of one depth-first search with ``best`` as the incumbent."""
    left, distinct = Counter(sizes), sorted(set(sizes))
    short = False

    def take(items: list[int], sign: int) -> None:
        for s in items:
            left[s] -= sign
            if sign > 0 and not left[s]:
                distinct.pop(bisect_left(distinct, s))
            elif sign < 0 and left[s] == 1:
                insort(distinct, s)

    # Depth-first: per level the container taken and the fillings that are still to be tried there.
    stack: list[tuple[list[int], list[list[int]]]] = []
    waste, nodes = 0, 0

    def expand() -> list[list[int]]:
        nonlocal short
        top = distinct[-1]
        take([top], 1)
        found, more = fillings(capacity - top, distinct, left, scale)
        short |= more
        options = [[top, *f] for f in found]
        take([top], -1)
        return options[::-1]

    options = expand()
    while len(best) > bound and nodes < budget:
        if options:
            items = options.pop()
            nodes += scale  # a node of a wider search costs as much more
            if waste + capacity - sum(items) > (len(best) - 1) * capacity - total:
                options = []
                continue
            take(items, 1)
            waste += capacity - sum(items)
            stack.append((items, options))
            if not distinct:
                best = [list(i) for i, _ in stack]
                options = []
            else:
                options = expand()
        elif stack:
            items, options = stack.pop()
            take(items, -1)
            waste -= capacity - sum(items)
        else:
            break
    return best, nodes, short


def _pack(pdf: pd.DataFrame, capacity: int, base: int) -> pd.DataFrame:
    """Containers of one group; items of size 0 go into its first container."""
    pdf = pdf.sort_values(["doc_id", "part"])
    waiting: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for d, p, s in zip(pdf["doc_id"], pdf["part"], pdf["tokens"], strict=True):
        waiting[s].append((d, p))
    empty = waiting.pop(0, [])
    bins = complete([s for s, items in waiting.items() for _ in items], capacity) or [[]]
    start = base + (int(pdf["grp"].iloc[0]) << 20)
    rows = [(start + b, i, *waiting[s].pop(0 if s else 0), s) for b, items in enumerate(bins) for i, s in enumerate(items)]
    rows += [(start, len(bins[0]) + i, d, p, 0) for i, (d, p) in enumerate(empty)]
    return pd.DataFrame(rows, columns=["container", "position", "doc_id", "part", "tokens"])


def _grouped(items: DataFrame, rows: int, group: int, capacity: int, base: int) -> DataFrame:
    n = max(1, math.ceil(rows / group))
    salted = items.withColumn("grp", F.pmod(F.xxhash64("doc_id", "part"), F.lit(n)).cast("int"))
    tasks = max(width(items.sparkSession), math.ceil(n / GROUPS_A_TASK))
    return salted.repartition(tasks, "grp").groupBy("grp").applyInPandas(lambda pdf: _pack(pdf, capacity, base), SCHEMA)


def containers(sizes: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``(container, position, doc_id, part, tokens)`` from ``(doc_id, n)``.

    Every row of ``sizes`` comes out, once per part: part 0 alone unless ``n`` exceeds ``capacity``. Items of size 0 (null or empty texts)
    take a position without room. Container numbers are unique, not dense. An empty input gives an empty result.
    """
    whole = F.floor(F.col("n") / capacity).cast("int")
    over = F.col("n") > capacity
    part = F.sequence(F.lit(0), F.when(over, F.ceil(F.col("n") / capacity).cast("int") - 1).otherwise(0))
    parts = sizes.select(F.col("doc_id").cast("long").alias("doc_id"), "n", F.explode(part).alias("part"))
    parts = cut(parts.select("doc_id", "part", F.when(over & (F.col("part") < whole), capacity).when(over, F.col("n") % capacity).otherwise(F.col("n")).cast("int").alias("tokens")))
    full, rest = parts.where(F.col("tokens") == capacity), parts.where(F.col("tokens") < capacity)
    alone = full.select((F.lit(3 << 60) + F.monotonically_increasing_id()).alias("container"), F.lit(0).alias("position"), "doc_id", "part", "tokens")
    first = cut(_grouped(rest, rest.count(), group, capacity, 0))
    fill = first.groupBy("container").agg(F.sum("tokens").alias("fill"))
    slack = fill.where(F.col("fill") < capacity - OPEN).select("container")
    again = cut(first.join(slack, "container", "left_semi").select("doc_id", "part", "tokens"))
    second = _grouped(again, again.count(), group, capacity, 1 << 60)
    return alone.unionByName(first.join(slack, "container", "left_anti")).unionByName(second)
