"""Suffix order of one shard by induced sorting, with common-prefix values.

Positions of type L are induced from smaller suffixes in a scan from the left, those of
type S in a scan from the right. The scans advance a bucket (first symbol) at a time; what
a bucket induces waits in queues of (position, common prefix with the entry before), one
queue a symbol, which go to disk when they outgrow `memory` bytes. Leftmost S positions
seed the scans: they are named by a first induction and ranked by recursion on the names.
Common prefixes are counted up to `cap` symbols, and so far the order is exact; suffixes
that agree in `cap` symbols may stand in any order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np


class BucketQueues:
    """First-in first-out queues of (position, prefix) by symbol, disk-backed."""

    def __init__(self, memory: int):
        self.memory, self.used = memory, 0
        self.held: dict[int, list[np.ndarray]] = {}
        self.files: dict[int, object] = {}

    def push(self, symbol: int, positions: np.ndarray, prefix: np.ndarray) -> None:
        block = np.empty(len(positions), [("at", np.int64), ("lcp", np.int16)])
        block["at"], block["lcp"] = positions, prefix
        self.held.setdefault(symbol, []).append(block)
        self.used += block.nbytes
        if self.used > self.memory:
            for s, blocks in self.held.items():
                f = self.files.setdefault(s, tempfile.TemporaryFile())  # noqa: SIM115
                for b in blocks:
                    b.tofile(f)
            self.held, self.used = {}, 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        blocks = self.held.pop(symbol, [])
        self.used -= sum(b.nbytes for b in blocks)
        if f := self.files.pop(symbol, None):
            f.seek(0)
            blocks = [np.fromfile(f, [("at", np.int64), ("lcp", np.int16)]), *blocks]
            f.close()
        if not blocks:
            return np.empty(0, np.int64), np.empty(0, np.int16)
        both = np.concatenate(blocks)
        return np.ascontiguousarray(both["at"]), np.ascontiguousarray(both["lcp"])


def range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low..high]) for each pair, by doubling."""
    out = np.zeros(len(low), values.dtype)
    level = np.frexp(high - low + 1)[1] - 1
    table = values
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        of = level == k
        out[of] = np.minimum(table[low[of]], table[high[of] - (1 << k) + 1])
    return out


def prefix_length(text: np.ndarray, a: int, b: int, cap: int) -> int:
    x, y = text[a : a + cap], text[b : b + cap]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


def types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S. The end of the text counts as smallest."""
    n = len(text)
    s = np.zeros(n, bool)
    if n < 2:
        return s
    at = np.where(text[:-1] != text[1:], np.arange(n - 1), n)
    at = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal symbols ends
    inside = at < n
    at = np.minimum(at, n - 2)
    s[:-1] = inside & (text[at] < text[at + 1])
    return s


def buckets(text: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, cap: int, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, common prefix with the one before) of each bucket, from the last to the first.

    seeds: leftmost S positions in suffix order.
    """

    def spread(queues: BucketQueues, symbol: int, at: np.ndarray, lcp: np.ndarray, s_side: bool) -> None:
        """What a whole bucket induces in other buckets."""
        k = np.flatnonzero(at > 0)
        before = at[k] - 1
        fit = (is_s[before] == s_side) & (text[before] != symbol)
        k, before = k[fit], before[fit]
        d = text[before]
        order = np.argsort(d, kind="stable")
        k, before, d = k[order], before[order], d[order]
        first = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else []
        near = np.zeros(len(k), np.int16)
        inner = np.ones(len(k), bool)
        inner[first] = False
        i = np.flatnonzero(inner)
        near[i] = range_min(lcp, k[i - 1] + 1, k[i])
        near = np.minimum(near + 1, cap)
        for a, z in zip(first, np.append(first[1:], len(k)), strict=True) if len(d) else ():
            part, value = before[a:z], near[a:z]
            if s_side:  # queued from the largest on; a value belongs to the pair with the one above
                part, value = part[::-1], np.append(1, value[:0:-1])
            queues.push(int(d[a]), part, value)

    def runs(symbol: int, at: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """With what the bucket induces in itself, turn by turn, in queue order.

        After cap turns all that is left begins with cap times the symbol, so it follows at once, in any order.
        """
        all_at, all_lcp, turn, near = [at], [lcp], at, lcp
        for depth in range(cap + 1):
            k = np.flatnonzero(turn > 0)
            k = k[text[turn[k] - 1] == symbol]
            if not len(k):
                break
            if depth == cap:
                length = turn[k] - run_starts()[turn[k] - 1]
                ends = np.cumsum(length)
                all_at.append(np.repeat(turn[k] - 1 + ends - length, length) - np.arange(ends[-1]))
                all_lcp.append(np.full(ends[-1], cap, np.int16))
                break
            value = np.empty(len(k), np.int16)
            value[1:] = np.minimum(range_min(near, k[:-1] + 1, k[1:]) + 1, cap)
            new = turn[k] - 1
            value[0] = prefix_length(text, int(turn[-1]), int(new[0]), cap)
            all_at.append(new)
            all_lcp.append(value)
            turn, near = new, value
        return np.concatenate(all_at), np.concatenate(all_lcp)

    held: list[np.ndarray] = []

    def run_starts() -> np.ndarray:
        """Where the run of equal symbols at each place begins."""
        if not held:
            new = np.append(True, text[1:] != text[:-1])
            held.append(np.maximum.accumulate(np.where(new, np.arange(len(text)), 0)))
        return held[0]

    symbols = np.unique(text)
    seed_symbol = text[seeds]
    queues, l_parts = BucketQueues(memory), BucketQueues(memory)
    last = len(text) - 1
    for c in symbols.tolist():
        at, lcp = queues.pop(c)
        if c == text[last] and not is_s[last]:  # the whole text's end induces its last position first
            at, lcp = np.append(last, at), np.append(0, np.append(1, lcp[1:]) if len(lcp) else lcp).astype(np.int16)
        if len(lcp):
            lcp[0] = 0
        at, lcp = runs(c, at, lcp)
        l_parts.push(c, at, lcp)
        a, z = np.searchsorted(seed_symbol, [c, c + 1]) if len(seeds) else (0, 0)
        own, near = seeds[a:z], seed_lcp[a:z].astype(np.int16)
        if len(own):
            near[0] = prefix_length(text, int(at[-1]), int(own[0]), cap) if len(at) else 0
        spread(queues, c, np.append(at, own), np.append(lcp, near), False)
    queues = BucketQueues(memory)
    for c in symbols.tolist()[::-1]:
        down, lcp_down = queues.pop(c)
        down, lcp_down = runs(c, down, lcp_down)  # value: with the entry before it in the queue, the next larger
        low, lcp = l_parts.pop(c)
        up = down[::-1]
        near = np.append(0, lcp_down[:0:-1]).astype(np.int16) if len(up) else np.empty(0, np.int16)
        if len(up) and len(low):
            near[0] = prefix_length(text, int(low[-1]), int(up[0]), cap)
        at, lcp = np.append(low, up), np.append(lcp, near)
        if len(lcp):
            lcp[0] = 0
        spread(queues, c, at, lcp, True)
        yield at, lcp


def rank_names(names: np.ndarray, places: np.ndarray, cap: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the suffixes of a string of names, to `cap` symbols of the text below.

    Prefix doubling in memory, in which only names still tied within the cap are sorted again;
    also the ranks (place of the first equal) of each doubling. places: of the names in the text.
    """
    n, width = len(names), 1
    order = np.argsort(names, kind="stable")
    sorted_ = names[order]
    head = np.append(True, sorted_[1:] != sorted_[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    ranks = [rank]
    while True:
        tied = ~head
        tied[:-1] |= ~head[1:]
        end = np.minimum(order + width, n - 1)
        live = np.flatnonzero(tied & (places[end] - places[order] < cap))
        # whole groups of ties, so that their places stay theirs
        if not len(live):
            return order, ranks
        group = np.zeros(n, bool)
        group[rank[order[live]]] = True
        live = np.flatnonzero(tied & group[rank[order]])
        who = order[live]
        after = np.full(len(who), -1, np.int64)
        ahead = who + width < n
        after[ahead] = rank[who[ahead] + width]
        key = rank[who] * (n + 1) + after + 1
        turn = np.argsort(key)
        order[live], key = who[turn], key[turn]
        fresh = np.append(True, key[1:] != key[:-1])
        head[live] = fresh | head[live]
        rank = rank.copy()
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        ranks.append(rank)
        width *= 2


def seed_order(text: np.ndarray, is_s: np.ndarray, cap: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Leftmost S positions in suffix order, and their common prefixes."""
    lms = np.flatnonzero(is_s & np.append(False, ~is_s[:-1]))
    if len(lms) < 2:
        return lms, np.zeros(len(lms), np.int16)
    rough = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    by_name = np.concatenate([at[is_lms[at]][::-1] for at, _ in buckets(text, is_s, rough, np.zeros(len(rough), np.int16), 1, memory)])[::-1]
    number = np.empty(len(text), np.int64)
    number[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms) + 1, len(text) - lms[-1])  # of the substring up to the next one
    where = number[by_name]
    size = length[where]
    same = (size[1:] == size[:-1]) & (where[1:] != len(lms) - 1) & (where[:-1] != len(lms) - 1)
    live = np.flatnonzero(same)
    step = 0
    while len(live):
        a, b = by_name[live] + step, by_name[live + 1] + step
        equal = text[a] == text[b]
        same[live[~equal]] = False
        step += 1
        live = live[equal & (step < size[live])]
    names = np.empty(len(lms), np.int64)
    names[where] = np.cumsum(np.append(0, ~same))
    order, ranks = rank_names(names, lms, cap)
    seeds = lms[order]
    i, j = order[:-1].copy(), order[1:].copy()
    live = np.ones(len(i), bool)
    for k in range(len(ranks) - 1, -1, -1):
        for _ in range(2 if k == len(ranks) - 1 else 1):
            inside = live & (i < len(lms)) & (j < len(lms))
            x = np.flatnonzero(inside)
            x = x[ranks[k][i[x]] == ranks[k][j[x]]]
            i[x] += 1 << k
            j[x] += 1 << k
            done = (i[x] >= len(lms)) | (j[x] >= len(lms))
            i[x[done]] -= 1 << k
            j[x[done]] -= 1 << k
            live[x[done]] = False
    lcp = np.zeros(len(seeds), np.int64)
    lcp[1:] = lms[i] - seeds[:-1]
    open_ = np.flatnonzero(lcp[1:] < cap) + 1
    while len(open_):
        a, b = seeds[open_ - 1] + lcp[open_], seeds[open_] + lcp[open_]
        inside = (a < len(text)) & (b < len(text))
        open_, a, b = open_[inside], a[inside], b[inside]
        equal = text[a] == text[b]
        open_ = open_[equal]
        lcp[open_] += 1
        open_ = open_[lcp[open_] < cap]
    return seeds, np.minimum(lcp, cap).astype(np.int16)


def suffix_buckets(text: np.ndarray, cap: int, memory: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffix order and common prefixes (up to cap, below 2**15), a bucket at a time from the last."""
    if not len(text):
        return
    is_s = types(text)
    seeds, lcp = seed_order(text, is_s, cap, memory)
    yield from buckets(text, is_s, seeds, lcp, cap, memory)
