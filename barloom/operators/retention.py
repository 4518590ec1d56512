"""What a live view holds, as summaries of runs of arrivals that can be joined.

A view follows every arrival: a symbol that resets forgets its points when the session
changes and again at the session's first regular-hours point; any other drops points from
the oldest on while they lie before the open less its window, so a young point shields the
older ones behind it; all hold `depth` points at most.

Applied point by point, that needs a symbol's rows one after the other. Here a run of
arrivals is reduced to a `Summary` of bounded size that says what the run makes of any
view before it: what its last session is, where its first regular-hours point lies, which
points are its newest, and, for each moment at which the points before the run can have
run out, how many of its own are left at its end. `then` joins two neighbouring runs and is
associative, so runs of any length may be summed up in any grouping.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np

VALUES = ("arrival", "bar_us", "open", "high", "low", "close")
NEVER = -(2**62)  # a cutoff before which nothing lies


@dataclass(frozen=True)
class Summary:
    """A run of arrivals of one symbol; the empty run has no points."""

    reset: bool
    depth: int
    n: int = 0
    session: int = 0  # of the last point
    first_session: int = 0
    one_session: bool = True  # no change of session inside the run
    run: int = 0  # points since the session last changed, at most those of the run
    since_regular: int | None = None  # of those, from the first in regular hours on
    open_us: int | None = None  # the earliest regular-hours point of those
    open_price: float | None = None
    points: dict[str, np.ndarray] = field(default_factory=dict)  # the newest `depth`
    cuts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # of the first `depth`
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    @property
    def held(self) -> dict[str, np.ndarray]:
        """The points a view holds after this run, if nothing came before."""
        if self.reset:
            n = self.run if self.since_regular is None else self.since_regular
        else:
            n = int(self.left[0])
        n = min(n, self.depth)
        return {c: v[len(v) - n :] for c, v in self.points.items()}


def _final_heads(bar: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """How many points are left at the end, by the arrival from which on they can be dropped.

    Entry t: points before the run shield it until arrival t. The oldest point held moves
    on when it lies before an arrival's cutoff, or when `depth` are held. While `depth` are
    held it is known, and the next arrival that drops more is looked up; so a start costs a
    step per drop, not per arrival, and starts that have met are followed once.
    """
    n = len(bar)
    starts = min(depth, n)
    drops = np.flatnonzero(bar[: max(0, n - depth)] < cut[depth:]) + depth if n > depth else np.empty(0, np.int64)
    known: dict[int, int] = {}
    out = np.empty(starts + 1, np.int64)
    for t in range(starts, -1, -1):
        head, at, met = 0, t, []
        while at < n:
            if at - head >= depth:  # full before this arrival: the head is `depth` back
                place = int(np.searchsorted(drops, at))
                if place in known:
                    head = known[place]
                    break
                met.append(place)
                if place == len(drops):
                    head = n - depth
                    break
                at = int(drops[place])
                head = at - depth
            else:  # the first arrival that drops the head before the view is full
                until = min(n, head + depth)
                hit = np.flatnonzero(cut[at:until] > bar[head]) if head < at else np.flatnonzero(cut[at + 1 : until] > bar[head]) + 1
                if not len(hit):
                    at = until
                    continue
                at += int(hit[0])
            stays = np.flatnonzero(bar[head:at] >= cut[at])
            head = head + int(stays[0]) if len(stays) else at
            at += 1
            if at - head > depth:
                head = at - depth
        for place in met:
            known[place] = head
        out[t] = n - max(head, n - depth)
    return out


def summed(reset: bool, depth: int, session: np.ndarray, regular: np.ndarray, cut: np.ndarray, points: dict[str, np.ndarray]) -> Summary:
    """The summary of a run of arrivals, in their order.

    `session` and `cut` hold each point's session and the time before which points are
    dropped when it arrives; `regular` says whether it lies in regular hours.
    """
    n = len(session)
    if not n:
        return Summary(reset, depth)
    changes = np.flatnonzero(session[1:] != session[:-1]) + 1
    start = int(changes[-1]) if len(changes) else 0
    in_hours = np.flatnonzero(regular[start:]) + start
    opening = in_hours[np.argmin(points["bar_us"][in_hours])] if len(in_hours) else None
    return Summary(
        reset=reset,
        depth=depth,
        n=n,
        session=int(session[-1]),
        first_session=int(session[0]),
        one_session=not len(changes),
        run=n - start,
        since_regular=n - int(in_hours[0]) if len(in_hours) else None,
        open_us=None if opening is None else int(points["bar_us"][opening]),
        open_price=None if opening is None else float(points["open"][opening]),
        points={c: v[-depth:] for c, v in points.items()},
        cuts=np.empty(0, np.int64) if reset else cut[:depth],
        left=np.zeros(1, np.int64) if reset else _final_heads(points["bar_us"], cut, depth),
    )


def _left_of(bars: np.ndarray, later: Summary, start: int = 0) -> int:
    """How many points are left when `later` follows a view that holds `bars`.

    With `start`, nothing can be dropped before that arrival of the later run.
    """
    head, depth = 0, later.depth
    for t in range(start, len(later.cuts)):
        while head < len(bars) and bars[head] < later.cuts[t]:
            head += 1
        if head == len(bars):
            return int(later.left[t])
        head = max(head, len(bars) + t + 1 - depth)
        if head == len(bars):
            return int(later.left[t + 1])
    return len(bars) - head + later.n


def _sessions(a: Summary, b: Summary) -> Summary:
    """`b` after `a`, as far as sessions and the newest points go."""
    points = {c: np.concatenate([a.points[c], v])[-a.depth :] for c, v in b.points.items()}
    both = replace(b, n=a.n + b.n, first_session=a.first_session, points=points, one_session=False)
    if not b.one_session or b.session != a.session:
        return both
    since = b.since_regular if a.since_regular is None else a.since_regular + b.n
    first = a if b.open_us is None or (a.open_us is not None and a.open_us <= b.open_us) else b
    return replace(
        both,
        one_session=a.one_session,
        run=a.run + b.n,
        since_regular=since,
        open_us=first.open_us,
        open_price=first.open_price,
    )


def then(a: Summary, b: Summary) -> Summary:
    """The summary of two neighbouring runs, `a` before `b`."""
    if not a.n or not b.n:
        return a if a.n else b
    both = _sessions(a, b)
    if a.reset:
        return both
    bars = a.points["bar_us"]
    after: dict[int, int] = {}
    left = []
    for t in range(min(a.depth, both.n) + 1):
        if t < len(a.left):
            own = int(a.left[t])
            if own not in after:
                after[own] = _left_of(bars[len(bars) - own :], b)
            left.append(after[own])
        else:  # what came before outlasts `a`
            left.append(_left_of(bars, b, t - a.n))
    return replace(both, cuts=np.concatenate([a.cuts, b.cuts])[: a.depth], left=np.array(left, np.int64))


def follow(view: Summary, later: Summary) -> Summary:
    """The view after a run: `then`, keeping only what a view needs."""
    if not later.n:
        return view
    both = _sessions(view, later) if view.n else later
    if both.reset:
        return both
    left = _left_of(view.points["bar_us"], later) if view.n else int(later.left[0])
    points = {c: v[len(v) - left :] for c, v in both.points.items()}
    return replace(both, points=points, cuts=np.empty(0, np.int64), left=np.array([left], np.int64))
