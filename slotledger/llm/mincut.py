"""Binary labelling of least cost by a minimum cut."""

from __future__ import annotations

from collections import deque

_EPSILON = 1e-12


def _settle(pull: list[float], edges: list[dict[int, float]]) -> list[bool | None]:
    """Labels that hold in some least-cost labelling: a node whose own pull is at least
    the sum of its edges keeps its side, and then pulls its neighbours."""
    labels: list[bool | None] = [None] * len(pull)
    ties = [sum(e.values()) for e in edges]
    waiting = deque(i for i in range(len(pull)) if abs(pull[i]) >= ties[i])
    while waiting:
        i = waiting.popleft()
        if labels[i] is not None:
            continue
        labels[i] = pull[i] > 0
        for j, weight in edges[i].items():
            if labels[j] is None:
                pull[j] += weight if labels[i] else -weight
                ties[j] -= weight
                if abs(pull[j]) >= ties[j]:
                    waiting.append(j)
    return labels


def _cut(nodes: list[int], pull: list[float], edges: list[dict[int, float]]) -> set[int]:
    """The source side (True) of a minimum cut of one component, by blocking flows."""
    source, sink, inside = -1, -2, set(nodes)
    room: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in nodes:
        room[i] = {j: w for j, w in edges[i].items() if j in inside}
        if pull[i] > 0:
            room[source][i], room[i][source] = pull[i], 0.0
        elif pull[i] < 0:
            room[i][sink], room[sink][i] = -pull[i], 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            i = queue.popleft()
            for j, left in room[i].items():
                if left > _EPSILON and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if sink not in level:
            return {i for i in nodes if i in level}
        ways = {i: list(room[i]) for i in level}  # places still to be tried
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                steps = list(zip(path, path[1:]))
                flow = min(room[a][b] for a, b in steps)
                for a, b in steps:
                    room[a][b] -= flow
                    room[b][a] += flow
                path = [source]
            elif not ways[i]:
                path.pop()
                if path:
                    ways[path[-1]].pop()
            elif room[i][j := ways[i][-1]] > _EPSILON and level.get(j) == level[i] + 1:
                path.append(j)
            else:
                ways[i].pop()


def label(pull: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost.

    ``pull[i]`` above 0 is what it costs to label i False, below 0 what it costs to label
    it True; each ``(i, j, weight)`` costs ``weight`` if i and j differ. Nodes without
    any preference are False.
    """
    edges: list[dict[int, float]] = [{} for _ in pull]
    for i, j, weight in ties:
        edges[i][j] = edges[i].get(j, 0.0) + weight
        edges[j][i] = edges[j].get(i, 0.0) + weight
    pull = list(pull)
    labels = _settle(pull, edges)
    for start in range(len(pull)):
        if labels[start] is not None:
            continue
        component, queue = {start}, [start]
        while queue:
            for j in edges[queue.pop()]:
                if labels[j] is None and j not in component:
                    component.add(j)
                    queue.append(j)
        kept = _cut(sorted(component), pull, edges)
        for i in component:
            labels[i] = i in kept
    return labels
