"""Each detector as a plain loop over one stream, to check the set-based forms against.

Events are tuples with time in seconds.  Nothing here is shared with the library.
"""

from __future__ import annotations

from collections import defaultdict


def by_key(events):
    groups = defaultdict(list)
    for key, *rest in events:
        groups[key].append(tuple(rest))
    return groups


def failure_windows(events, length, at_least=2):
    """events: (key, t, failed)."""
    out = []
    for key, rows in by_key(events).items():
        opened, fails = None, []
        for t, failed in sorted(rows, key=lambda r: (r[0], not r[1])):
            if opened is not None and t > opened + length:
                if len(fails) >= at_least:
                    out.append((key, fails[0], fails[-1], len(fails)))
                opened, fails = None, []
            if not failed:
                opened, fails = None, []
            elif opened is None:
                opened, fails = t, [t]
            else:
                fails.append(t)
        if len(fails) >= at_least:
            out.append((key, fails[0], fails[-1], len(fails)))
    return sorted(out)


def failure_pairs(events, within):
    """events: (key, t, tie, failed)."""
    out = []
    for key, rows in by_key(events).items():
        kept = None
        for t, _, failed in sorted(rows):
            if failed and kept is not None and kept + within > t:
                out.append((key, kept, t))
            kept = t if failed else None
    return sorted(out)


def strict_sequence(events, tests, within=None):
    """events: (key, t, tie, value); tests: one predicate per step.  Gives the ties."""
    out = []
    for key, rows in by_key(events).items():
        rows = sorted(rows)
        for i in range(len(rows) - len(tests) + 1):
            part = rows[i : i + len(tests)]
            if all(f(r[2]) for f, r in zip(tests, part)):
                if within is None or part[-1][0] - part[0][0] < within:
                    out.append((key, *[r[1] for r in part]))
    return sorted(out)


def relaxed_sequence(events, tests, within):
    out = []
    for key, rows in by_key(events).items():
        rows = sorted(rows)
        for i, start in enumerate(rows):
            if not tests[0](start[2]):
                continue
            found, pos = [start], i
            for test in tests[1:]:
                pos = next((j for j in range(pos + 1, len(rows)) if test(rows[j][2])), None)
                if pos is None or rows[pos][0] - start[0] >= within:
                    break
                found.append(rows[pos])
            ties = [r[1] for r in found] + [None] * (len(tests) - len(found))
            out.append((key, *ties, "matched" if len(found) == len(tests) else "timeout"))
    return sorted(out, key=str)


def order_states(events, within):
    """events: (key, t, tie, kind) with kind create, pay or other."""
    out = []
    for key, rows in by_key(events).items():
        armed = None
        for t, tie, kind in sorted(rows, key=lambda r: (r[0], r[2] == "pay", r[1])):
            if armed is not None and t > armed[0] + within:
                out.append((key, armed[0] + within, armed[1], "create_without_pay"))
                armed = None
            if kind == "create":
                armed = (t, tie)
            elif kind == "pay":
                out.append((key, t, tie, "paid" if armed else "pay_without_create"))
                armed = None
        if armed:
            out.append((key, armed[0] + within, armed[1], "create_without_pay"))
    return sorted(out)


def reconcile(events, wait):
    """events: (key, t, tie, side); gives (key, left tie, right tie, tag)."""
    alone = ("left_only", "right_only")
    out = []

    def lone(key, row):
        ties = [None, None]
        ties[row[2]] = row[1]
        out.append((key, *ties, alone[row[2]]))

    for key, rows in by_key(events).items():
        waiting = None
        for t, tie, side in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
            if waiting is not None and t > waiting[0] + wait:
                lone(key, waiting)
                waiting = None
            if waiting is None:
                waiting = (t, tie, side)
            elif waiting[2] == side:
                lone(key, waiting)
                waiting = (t, tie, side)
            else:
                ties = [None, None]
                ties[side], ties[waiting[2]] = tie, waiting[1]
                out.append((key, *ties, "matched"))
                waiting = None
        if waiting is not None:
            lone(key, waiting)
    return sorted(out, key=str)


def interval_pairs(lefts, rights, before, after, low_in=True, high_in=True):
    """(key, t, tie) on both sides."""
    out = []
    for k1, t1, i1 in lefts:
        for k2, t2, i2 in rights:
            gap = t2 - t1
            low = gap >= -before if low_in else gap > -before
            high = gap <= after if high_in else gap < after
            if k1 == k2 and low and high:
                out.append((k1, i1, i2))
    return sorted(out)


def outer_pairs(lefts, rights, before, after, how):
    """The pairs, and rows of the left side, or of both, without any; null keys have no partner."""
    pairs = [
        (k, i, j) for k, t, i in lefts for o, u, j in rights if k is not None and k == o and t - before <= u <= t + after
    ]
    out = pairs + [(k, i, None) for k, _, i in lefts if i not in {p[1] for p in pairs}]
    if how == "full":
        out += [(k, None, j) for k, _, j in rights if j not in {p[2] for p in pairs}]
    return sorted(out, key=str)


def click_filter(events, limit):
    """events: (key, t, tie); local days start at 16:00 of the day before."""
    seen = defaultdict(int)
    out = []
    for key, t, tie in sorted(events, key=lambda e: (e[1], e[2])):
        day = (key, (t + 8 * 3600) // 86400)
        seen[day] += 1
        if seen[day] <= limit:
            out.append((key, tie, "pass"))
        elif seen[day] == limit + 1:
            out.append((key, tie, "warning"))
    return sorted(out)


def running_distinct(events, size):
    """events: (value, t, tie); gives (tie, distinct values so far in the window)."""
    seen = defaultdict(set)
    out = []
    for value, t, tie in sorted(events, key=lambda e: (e[1], e[2])):
        window = seen[t // size]
        window.add(value)
        out.append((tie, len(window)))
    return sorted(out)


def late_replay(events, size, slide, bound, lateness):
    """events: (key, t, arrival, tie).  Gives the final counts, first counts and late ties."""
    final, first, late = defaultdict(int), defaultdict(int), []
    progress = None
    for key, t, _, tie in sorted(events, key=lambda e: (e[2], e[3])):
        ends = [t // slide * slide + slide * (i + 1) for i in range(size // slide)]
        open_ends = [
            e for e in ends if progress is None or e + lateness > progress - bound
        ]
        for e in open_ends:
            final[(key, e)] += 1
            if progress is None or e > progress - bound:
                first[(key, e)] += 1
        if not open_ends:
            late.append(tie)
        progress = t if progress is None else max(progress, t)
    return dict(final), dict(first), sorted(late)
