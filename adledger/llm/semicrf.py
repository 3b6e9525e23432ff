"""A semi-Markov conditional random field over candidate segments.

A text is a sequence of segments: single characters outside any entity, and entities of
bounded length. Features look at a whole candidate span. A character outside scores 0, so the
score of an entity segment, with its transition from the segment before, is its log odds
against leaving the span alone. Only regions with candidates are searched; elsewhere nothing
can be chosen.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)


@dataclass
class Segment:
    """A candidate entity: code points [start, end), number of its kind, names of its features."""

    start: int
    end: int
    kind: int
    features: list[str]


@dataclass
class Model:
    """Weights of features, and of the transitions from the kind before (or OUTSIDE) to a kind."""

    weights: dict[str, float] = field(default_factory=dict)
    moves: list[list[float]] = field(default_factory=lambda: [[0.0] * len(KINDS) for _ in range(OUTSIDE + 1)])

    def score(self, segment: Segment) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in segment.features)


def regions(segments: list[Segment]) -> list[list[Segment]]:
    """Segments that overlap or touch, directly or by others, in order of their ends."""
    out, reach = [], -1
    for s in sorted(segments, key=lambda s: (s.start, s.end, s.kind)):
        if s.start > reach:
            out.append([])
        out[-1].append(s)
        reach = max(reach, s.end)
    for region in out:
        region.sort(key=lambda s: (s.end, s.start, s.kind))
    return out


def borders(region: list[Segment]) -> list[int]:
    return sorted({s.start for s in region} | {s.end for s in region})


def decode(model: Model, region: list[Segment]) -> list[tuple[Segment, float]]:
    """The segments of the best way through a region, each with its log odds."""
    places = borders(region)
    at = {p: i for i, p in enumerate(places)}
    best = [[-math.inf] * (OUTSIDE + 1) for _ in places]
    back: list[list[tuple | None]] = [[None] * (OUTSIDE + 1) for _ in places]
    best[0][OUTSIDE] = 0.0
    waiting = iter(region)
    segment = next(waiting, None)
    for i in range(1, len(places)):
        before = max(range(OUTSIDE + 1), key=lambda k: best[i - 1][k])
        best[i][OUTSIDE], back[i][OUTSIDE] = best[i - 1][before], (i - 1, before, None, 0.0)
        while segment is not None and segment.end == places[i]:
            j, own = at[segment.start], model.score(segment)
            for k in range(OUTSIDE + 1):
                gain = own + model.moves[k][segment.kind]
                if best[j][k] + gain > best[i][segment.kind]:
                    best[i][segment.kind], back[i][segment.kind] = best[j][k] + gain, (j, k, segment, gain)
            segment = next(waiting, None)
    i, k = len(places) - 1, max(range(OUTSIDE + 1), key=lambda k: best[-1][k])
    found = []
    while back[i][k] is not None:
        i, k, segment, gain = back[i][k]
        if segment is not None:
            found.append((segment, gain))
    return found[::-1]


def log_sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def marginals(model: Model, region: list[Segment]) -> tuple[list[list[float]], float]:
    """(P(segment entered from kind k) for every segment and k, log of the normaliser)."""
    places = borders(region)
    at = {p: i for i, p in enumerate(places)}
    scores = [model.score(s) for s in region]
    ways: list[list[list[float]]] = [[[] for _ in range(OUTSIDE + 1)] for _ in places]
    ways[0][OUTSIDE].append(0.0)
    alpha = [[-math.inf] * (OUTSIDE + 1) for _ in places]
    alpha[0][OUTSIDE] = 0.0
    n = 0
    for i in range(1, len(places)):
        ways[i][OUTSIDE].append(log_sum(alpha[i - 1]))
        while n < len(region) and region[n].end == places[i]:
            s = region[n]
            ways[i][s.kind].append(scores[n] + log_sum([alpha[at[s.start]][k] + model.moves[k][s.kind] for k in range(OUTSIDE + 1)]))
            n += 1
        alpha[i] = [log_sum(w) if w else -math.inf for w in ways[i]]
    whole = log_sum(alpha[-1])
    beta: list[list[float]] = [[0.0] * (OUTSIDE + 1) for _ in places]
    out: list[list[float]] = [[0.0] * (OUTSIDE + 1) for _ in region]
    starting: dict[int, list[int]] = {}
    for n, s in enumerate(region):
        starting.setdefault(s.start, []).append(n)
    for i in range(len(places) - 2, -1, -1):
        for k in range(OUTSIDE + 1):
            rest = [beta[i + 1][OUTSIDE]]
            for n in starting.get(places[i], ()):
                s = region[n]
                way = model.moves[k][s.kind] + scores[n] + beta[at[s.end]][s.kind]
                rest.append(way)
                if alpha[i][k] > -math.inf:
                    out[n][k] = math.exp(alpha[i][k] + way - whole)
            beta[i][k] = log_sum(rest)
    return out, whole


def entered_from(region: list[Segment], gold: list[int]) -> list[tuple[int, int]]:
    """(segment number, kind before) of a chosen set of segments that do not overlap."""
    out, end, kind = [], None, OUTSIDE
    for n in sorted(gold, key=lambda n: region[n].start):
        out.append((n, kind if region[n].start == end else OUTSIDE))
        end, kind = region[n].end, region[n].kind
    return out


def likelihood(model: Model, region: list[Segment], gold: list[int]) -> float:
    """log P(gold | region)."""
    entered = entered_from(region, gold)
    own = sum(model.score(region[n]) + model.moves[k][region[n].kind] for n, k in entered)
    return own - marginals(model, region)[1]


def fit(examples: list[tuple[list[Segment], list[int]]], least: int = 5, epochs: int = 6, rate: float = 0.3, penalty: float = 1e-3, seed: int = 1) -> Model:
    """Maximise the conditional likelihood by AdaGrad over regions. ``examples``: a region and the
    numbers of its true segments; features seen in fewer than ``least`` regions are dropped."""
    seen: dict[str, int] = {}
    for region, _ in examples:
        for f in {f for s in region for f in s.features}:
            seen[f] = seen.get(f, 0) + 1
    model = Model({f: 0.0 for f in sorted(seen) if seen[f] >= least})
    squares: dict[object, float] = {}
    order, draw = list(range(len(examples))), random.Random(seed)
    for _ in range(epochs):
        draw.shuffle(order)
        for number in order:
            region, gold = examples[number]
            expected, _ = marginals(model, region)
            slope: dict[object, float] = {}
            for n, k in entered_from(region, gold):
                for f in region[n].features:
                    slope[f] = slope.get(f, 0.0) + 1.0
                move = (k, region[n].kind)
                slope[move] = slope.get(move, 0.0) + 1.0
            for n, s in enumerate(region):
                total = sum(expected[n])
                if total < 1e-9:
                    continue
                for f in s.features:
                    slope[f] = slope.get(f, 0.0) - total
                for k, p in enumerate(expected[n]):
                    if p > 1e-9:
                        slope[k, s.kind] = slope.get((k, s.kind), 0.0) - p
            for f, g in slope.items():
                if isinstance(f, str):
                    if f not in model.weights:
                        continue
                    g -= penalty * model.weights[f]
                    squares[f] = squares.get(f, 0.0) + g * g
                    model.weights[f] += rate * g / math.sqrt(squares[f] + 1e-12)
                else:
                    g -= penalty * model.moves[f[0]][f[1]]
                    squares[f] = squares.get(f, 0.0) + g * g
                    model.moves[f[0]][f[1]] += rate * g / math.sqrt(squares[f] + 1e-12)
    return model
