"""A run-compressed Burrows-Wheeler index with sampled run ends, and matching statistics over it.

The index keeps one entry per run of the transform: its first row, symbol, the row its symbols map
to, and the text positions of its first and last row. Queries are streamed from their last symbol to
their first, all queries at once: where the current row's symbol is the wanted one the match grows,
otherwise it moves to the nearest run end with that symbol above or below, whichever shares more with
the present match. That gives the length of the longest match at every position (matching statistics).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a text of small non-negative numbers whose last symbol is the smallest
    and occurs once; by doubling, from three symbols on."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    take = max(1, 62 // bits)
    padded = np.concatenate([text.astype(np.int64), np.zeros(take, np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for j in range(take):
        key = (key << bits) | padded[j : j + n]
    depth = take
    while True:
        order = np.argsort(key, kind="stable")
        step = np.ones(n, dtype=np.int64)
        step[0] = 0
        in_order = key[order]
        step[1:] = in_order[1:] != in_order[:-1]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(step)
        if step[1:].all():
            return order
        later = np.full(n, 0, dtype=np.int64)
        later[: max(0, n - depth)] = rank[depth:] + 1
        key = rank * (n + 2) + later
        depth *= 2


class RunLengthIndex:
    def __init__(self, text: np.ndarray) -> None:
        """`text`: numbers below 65536; it ends with its smallest symbol, which occurs nowhere else."""
        self.text = text
        # four symbols from each place on as one number; what follows the end differs from place to place
        padded = np.concatenate([text.astype(np.uint16), np.zeros(4, np.uint16)])
        self.lanes = np.ndarray((len(text),), dtype="<u8", buffer=padded.data, strides=(2,))
        order = suffix_array(text)
        last = text[order - 1]
        fresh = np.ones(len(text), dtype=bool)
        fresh[1:] = last[1:] != last[:-1]
        self.start = np.flatnonzero(fresh)
        self.symbol = last[self.start].astype(np.int64)
        lengths = np.diff(np.append(self.start, len(text)))
        self.end = self.start + lengths - 1
        self.at_start, self.at_end = order[self.start], order[self.end]
        self.runs = len(self.start)
        by_symbol = np.argsort(self.symbol, kind="stable")
        self.maps_to = np.empty(self.runs, dtype=np.int64)
        self.maps_to[by_symbol] = np.concatenate([[0], np.cumsum(lengths[by_symbol])[:-1]])
        # runs sorted by symbol, then place: finds the nearest run of a symbol
        self.places = self.symbol[by_symbol] * self.runs + by_symbol

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length, up to `most`, that the suffixes at a and b have in common; four symbols at a time."""
        out, live, t = np.zeros(len(a), dtype=np.int64), np.flatnonzero(most > 0), 0
        while len(live):
            differ = self.lanes[a[live] + t] ^ self.lanes[b[live] + t]
            equal = (differ & 0xFFFF == 0).astype(np.int64)
            equal += differ & 0xFFFFFFFF == 0
            equal += differ & 0xFFFFFFFFFFFF == 0
            equal += differ == 0
            t += 4
            out[live] = t - 4 + equal
            live = live[equal == 4]
            live = live[(most[live] > t) & (np.maximum(a[live], b[live]) + t < len(self.text))]
        return np.minimum(out, most)

    def matching_statistics(self, queries: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Yields, position by position from each query's end: query numbers, positions, match lengths."""
        live = np.flatnonzero(ends > starts)
        at = ends.astype(np.int64) - 1
        row = np.zeros(len(starts), dtype=np.int64)
        place = np.full(len(starts), self.at_start[0], dtype=np.int64)
        length = np.zeros(len(starts), dtype=np.int64)
        while len(live):
            want = queries[at[live]].astype(np.int64)
            r = row[live]
            run = np.searchsorted(self.start, r, "right") - 1
            same = self.symbol[run] == want
            move = np.flatnonzero(~same)
            new_row = self.maps_to[run] + (r - self.start[run])
            new_place, new_length = place[live] - 1, length[live] + 1
            if len(move):
                w, now, l_now = want[move], place[live[move]], length[live[move]]
                k = np.searchsorted(self.places, w * self.runs + run[move])
                below = self.places[np.minimum(k, self.runs - 1)]
                above = self.places[np.maximum(k - 1, 0)]
                has_below = (k < self.runs) & (below // self.runs == w)
                has_above = (k > 0) & (above // self.runs == w)
                below, above = below % self.runs, above % self.runs
                c_below = np.where(has_below, self._common(now, self.at_start[below], np.where(has_below, l_now, 0)), -1)
                c_above = np.where(has_above, self._common(now, self.at_end[above], np.where(has_above, l_now, 0)), -1)
                down = c_below >= c_above
                best = np.maximum(c_below, c_above)
                to = np.where(down, below, above)
                from_row = np.where(down, self.start[to], self.end[to])
                known = best >= 0
                new_row[move] = np.where(known, self.maps_to[to] + (from_row - self.start[to]), 0)
                new_place[move] = np.where(known, np.where(down, self.at_start[to], self.at_end[to]) - 1, self.at_start[0])
                new_length[move] = np.where(known, best + 1, 0)
            row[live], place[live], length[live] = new_row, new_place, new_length
            yield live, at[live], new_length
            at[live] -= 1
            live = live[at[live] >= starts[live]]
