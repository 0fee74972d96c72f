"""Capped weights; plain Python, so workers need nothing else."""

from __future__ import annotations

# Fixed value: the largest share of one name.
MAX_WEIGHT = 0.15


def capped(scores_: list[float], cap: float = MAX_WEIGHT, passes: int = 10) -> list[float]:
    """Weights in percent by score, none above the cap: what is over is shared by weight among those that weren't over in that pass."""
    s = [max(0.0, x) for x in scores_]
    w = [x / sum(s) for x in s] if sum(s) > 0 else [1.0 / len(s)] * len(s)
    for _ in range(passes):
        over = [x > cap for x in w]
        if not any(over):
            break
        spare = sum(x - cap for x, o in zip(w, over) if o)
        room = sum(x for x, o in zip(w, over) if not o)
        w = [cap if o else x for x, o in zip(w, over)]
        if room <= 0:
            break
        w = [x if o else x + spare * x / room for x, o in zip(w, over)]
    return [round(x * 100, 2) for x in w]
