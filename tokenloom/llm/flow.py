"""Minimum-cost flow on small graphs of shards, sources or membership patterns.

Such graphs have one node per shard or source, never per document, so they are solved on the driver.
"""

from __future__ import annotations

import heapq


class FlowNetwork:
    """Directed graph with whole-number capacities and costs of zero or more.

    `solve` sends as much as it can from `source` to `sink` along successive cheapest paths, which
    for such costs gives a maximum flow of the least total cost.
    """

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int = 0) -> int:
        """Add an edge and return its number; number + 1 is its reverse."""
        number = len(self.to)
        for tail, head, space, price in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[tail].append(len(self.to))
            self.to.append(head)
            self.room.append(space)
            self.cost.append(price)
        return number

    def sent(self, number: int) -> int:
        return self.room[number + 1]

    def solve(self, source: int, sink: int) -> int:
        """Returns how much arrived."""
        potential = [0] * len(self.out)
        arrived = 0
        while True:
            far: list[int | None] = [None] * len(self.out)
            by = [-1] * len(self.out)
            far[source] = 0
            queue = [(0, source)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.out[a]:
                    if not self.room[e]:
                        continue
                    b = self.to[e]
                    nd = d + self.cost[e] + potential[a] - potential[b]
                    if far[b] is None or nd < far[b]:
                        far[b], by[b] = nd, e
                        heapq.heappush(queue, (nd, b))
            if far[sink] is None:
                return arrived
            most = max(d for d in far if d is not None)
            potential = [p + (most if d is None else d) for p, d in zip(potential, far)]
            # Send along the cheapest path as much as it can take.
            room, b = None, sink
            while b != source:
                e = by[b]
                room = self.room[e] if room is None else min(room, self.room[e])
                b = self.to[e ^ 1]
            b = sink
            while b != source:
                e = by[b]
                self.room[e] -= room
                self.room[e ^ 1] += room
                b = self.to[e ^ 1]
            arrived += room
