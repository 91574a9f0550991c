"""Minimum-cost flow between shards, and whole blocks to realise it. Small numbers only: sizes of shards and of blocks, never rows."""

from __future__ import annotations

import heapq

import numpy as np

#: Cost of a moved byte, and what crossing from one zone to another adds: fewest bytes first, then fewest between zones.
MOVED, CROSSED = 1_000_000, 1


def transfers(old: list[int], room: list[int], zones: list[int] | None = None) -> dict[tuple[int, int], int]:
    """Bytes that go from old shard i to new shard j, i == j left out, so that no new shard holds more than its room.

    Old and new shards of one number are the same place and cost nothing. All other bytes leave by the hub of their zone and
    enter by that of the new shard's, so there are as many arcs as shards and pairs of zones. Solved by shortest
    augmenting paths with potentials; each path empties a shard, fills one, or uses up an arc.
    """
    if sum(old) > sum(room):
        raise ValueError("the shards have more bytes than room")
    n, m = len(old), len(room)
    zones = zones or [0] * max(n, m)
    hubs = sorted(set(zones))
    source, sink, enter, leave = 0, 1, 2, 2 + len(hubs)
    first_old, first_new = leave + len(hubs), leave + len(hubs) + n
    nodes = first_new + m
    to, free, cost, out = [], [], [], [[] for _ in range(nodes)]

    def arc(a: int, b: int, most: int, price: int) -> None:
        for x, y, f, p in ((a, b, most, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y), free.append(f), cost.append(p)

    everything = sum(old)
    for i, size in enumerate(old):
        arc(source, first_old + i, size, 0)
        if i < m:
            arc(first_old + i, first_new + i, everything, 0)
        arc(first_old + i, leave + hubs.index(zones[i]), everything, MOVED)
    for a in range(len(hubs)):
        for b in range(len(hubs)):
            arc(leave + a, enter + b, everything, CROSSED * (a != b))
    for j, size in enumerate(room):
        arc(enter + hubs.index(zones[j]), first_new + j, everything, 0)
        arc(first_new + j, sink, size, 0)

    potential, left = [0] * nodes, everything
    while left:
        far, via = [None] * nodes, [-1] * nodes
        queue, far[source] = [(0, source)], 0
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out[a]:
                if free[e] and (far[to[e]] is None or d + cost[e] + potential[a] - potential[to[e]] < far[to[e]]):
                    far[to[e]], via[to[e]] = d + cost[e] + potential[a] - potential[to[e]], e
                    heapq.heappush(queue, (far[to[e]], to[e]))
        potential = [p + (f if f is not None else far[sink]) for p, f in zip(potential, far)]
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = to[via[at] ^ 1]
        step = min(left, *(free[e] for e in path))
        for e in path:
            free[e] -= step
            free[e ^ 1] += step
        left -= step

    # what passed each hub, taken apart into pairs: leaving shards in order, arcs between hubs, entering shards in order
    sent = lambda a, b: sum(free[e ^ 1] for e in out[a] if e % 2 == 0 and to[e] == b)
    given = {z: [[i, sent(first_old + i, leave + z)] for i in range(n) if hubs.index(zones[i]) == z] for z in range(len(hubs))}
    taken = {z: [[j, sent(enter + z, first_new + j)] for j in range(m) if hubs.index(zones[j]) == z] for z in range(len(hubs))}
    found: dict[tuple[int, int], int] = {}
    for a in range(len(hubs)):
        for b in range(len(hubs)):
            rest = sent(leave + a, enter + b)
            while rest:
                i, j = next(x for x in given[a] if x[1]), next(x for x in taken[b] if x[1])
                step = min(rest, i[1], j[1])
                i[1], j[1], rest = i[1] - step, j[1] - step, rest - step
                if i[0] != j[0]:
                    found[i[0], j[0]] = found.get((i[0], j[0]), 0) + step
    return found


def placed(shard: np.ndarray, size: np.ndarray, moves: dict[tuple[int, int], int], shards: int) -> np.ndarray:
    """The new shard of each block. shard, size (above 0): of the blocks, those of one file side by side.

    A shard's blocks leave from its last one on, so that few files are touched, each by the transfer that has most left and
    only if it takes at least half of the block; shards that go are emptied. Then blocks go from larger to smaller shards as long as that brings two shards
    nearer to each other, blocks that move anyway first. At the end a shard exceeds another by its smallest block at most.
    """
    now = shard.copy()
    for i in {a for a, _ in moves}:
        left = {j: f for (a, j), f in moves.items() if a == i}
        for b in np.flatnonzero(shard == i)[::-1]:
            j = max(left, key=left.get)
            if 2 * left[j] >= size[b] or i >= shards:
                left[j] -= int(size[b])
                now[b] = j
    held = np.bincount(now, weights=size, minlength=shards).astype(np.int64)
    stuck = False
    while not stuck:
        low, stuck = int(held.argmin()), True
        for high in np.argsort(-held, kind="stable"):
            gap = held[high] - held[low]
            own = np.flatnonzero((now == high) & (size < gap))
            if len(own):
                free = own[now[own] != shard[own]]
                free = free[np.abs(gap - 2 * size[free]) <= gap // 2] if len(free) else free
                pick = free if len(free) else own
                b = pick[np.abs(gap - 2 * size[pick]).argmin()]
                held[high] -= size[b]
                held[low] += size[b]
                now[b], stuck = low, False
                break
    return now
