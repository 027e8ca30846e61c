"""Names of windows of a sequence, and the anchors that stand for them.

A sequence (bytes, or hashed words) is an array of 64-bit codes. The *name* of the window
of k elements at p is a 64-bit number equal for equal windows; names are made by doubling:
``name(p, 2k) = mix(name(p, k), name(p + k, k))``.

The *anchor* of a window of ``length`` elements is the leftmost of its shorter windows of
``gram`` elements with the least name. Equal windows have equal anchors at equal offsets, so
a window can repeat only if its anchor's gram does. Neighbouring windows mostly share one
anchor: a *run* is a stretch of windows with one anchor, and all of them lie in its *block*.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """One 64-bit number for an ordered pair."""
    x = a * _K1 + (b ^ _K2)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_names(codes: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """Names of all windows of each length; an array per length, empty if none fits."""
    power, doubled = 1, mix(codes, np.uint64(0))
    built: dict[int, np.ndarray | None] = dict.fromkeys(lengths)
    width = dict.fromkeys(lengths, 0)
    while power <= max(lengths):
        for n in lengths:
            # Append this power of two, if n has it, to what n has so far.
            if n & power:
                have, at = built[n], width[n]
                built[n] = doubled if have is None else mix(have[: max(0, len(doubled) - at)], doubled[at:])
                width[n] = at + power
        doubled = mix(doubled[: max(0, len(doubled) - power)], doubled[power:])
        power *= 2
    return [built[n] for n in lengths]


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value of each stretch of ``width`` values."""
    at, span = np.arange(len(values), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: len(at) - step], at[step:]
        # Overlapping stretches share values, so ties go to the left position.
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


@dataclass
class Runs:
    """Runs of windows that share an anchor: gram name, block name, first and last window."""

    gram: np.ndarray
    block: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    names: np.ndarray

    def windows(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Offsets from anchor and names of the windows of run ``i``."""
        at = np.arange(self.first[i], self.last[i] + 1)
        return self.anchor[i] - at, self.names[at]


def anchor_runs(codes: np.ndarray, length: int, gram: int, sizes: np.ndarray | None = None) -> Runs | None:
    """The runs of a sequence; None if it is shorter than a window.

    With ``sizes`` the sequence is several, one after the other; windows across their borders are none.
    """
    at = np.arange(max(0, len(codes) - length + 1))
    if sizes is not None:
        ends = np.cumsum(sizes)
        at = at[at + length <= np.repeat(ends, sizes)[: len(at)]]
    if not len(at):
        return None
    grams, names = window_names(codes, [gram, length])
    # An anchor lies within its window, so no run passes a border either.
    anchor = leftmost_least(grams, length - gram + 1)[at]
    cuts = np.flatnonzero(np.diff(anchor)) + 1
    first, last = at[np.append(0, cuts)], at[np.append(cuts, len(anchor)) - 1]
    anchors = anchor[np.append(0, cuts)].astype(np.int64)
    # First and last window overlap, so their names and places tell the whole block.
    places = ((anchors - first) * length + (last - first)).astype(np.uint64)
    block = mix(mix(names[first], names[last]), places)
    return Runs(grams[anchors], block, first, last, anchors, names)
