"""A plain model of one satellite load, used to check the Spark one.

Records are (fk, millis, value).  It follows the rules one record at a time:
walk each parent's sorted timeline, skip stored records, and take out a new one
that repeats its neighbour.  Written for small inputs only.
"""

from __future__ import annotations


def blank_to_none(value):
    return None if value == "" else value


def load(stored, batch, idempotent=True, max_flag="max"):
    """Return (inserts, closings); ``batch`` is in order of precedence."""
    timelines = {}
    touched = {fk for fk, _, _ in batch}
    for fk, at, value in stored:
        if fk in touched:
            timelines.setdefault(fk, {}).setdefault(at, (blank_to_none(value), True))
    for fk, at, value in batch:
        timelines.setdefault(fk, {}).setdefault(at, (blank_to_none(value), False))

    inserts, closings = set(), set()
    for fk, timeline in timelines.items():
        if idempotent:
            for at in sorted(timeline):
                value, is_stored = timeline[at]
                if is_stored:
                    continue
                earlier = [t for t in timeline if t < at]
                later = [t for t in timeline if t > at]
                neighbour = max(earlier) if earlier else min(later, default=None)
                if neighbour is not None and timeline[neighbour][0] == value:
                    del timeline[at]
        times = sorted(timeline)
        for at, following in zip(times, times[1:] + [None]):
            value, is_stored = timeline[at]
            if not is_stored:
                inserts.add((fk, at, value, max_flag if following is None else following))
            elif following is not None and not timeline[following][1]:
                closings.add((fk, at, following))
    return inserts, closings
