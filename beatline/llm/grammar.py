"""Re-Pair grammars of word sequences, and the runs that they show."""

import heapq
from dataclasses import dataclass

import numpy as np

# An odd factor and as many pseudo-random values as a text has words make prefix hashes; equal stretches have equal ones.
_FACTOR = 0x9E3779B97F4A7C15


@dataclass
class Grammar:
    """Rules ``left right`` of nonterminals, each with its number of words and a place where it occurs.

    Symbols below ``terminals`` are words; symbol ``terminals + i`` is rule ``i``.  Both parts of a rule are older symbols.
    ``roots`` are (place, symbol): the derivation trees that make up the text.
    """

    terminals: int
    left: list[int]
    right: list[int]
    length: list[int]
    place: list[int]
    roots: list[tuple[int, int]]


def re_pair(words: np.ndarray, stretches: list[tuple[int, int]]) -> Grammar:
    """The grammar of some stretches of a text, pairs that cross their borders left alone.

    The most frequent pair of neighbouring symbols becomes a new symbol until no pair occurs twice; of equally frequent
    pairs the oldest is next, which keeps the rules of long repeats balanced.  What is left of a stretch is then paired
    level by level, so that each stretch is one derivation tree.  Each word is replaced once per level of its tree, in
    time that does not depend on the text's length, save for the queue.
    """
    terminals = int(words.max()) + 1 if len(words) else 0
    symbol = words.tolist()
    n = len(symbol)
    following, before = [-1] * n, [-1] * n
    places: dict[tuple[int, int], list[int]] = {}
    for start, end in stretches:
        for i in range(start, end - 1):
            following[i], before[i + 1] = i + 1, i
            places.setdefault((symbol[i], symbol[i + 1]), []).append(i)
    count = {pair: len(found) for pair, found in places.items()}
    queue = [(-times, age, pair) for age, (pair, times) in enumerate(count.items()) if times > 1]
    heapq.heapify(queue)
    age = len(count)
    left: list[int] = []
    right: list[int] = []
    length: list[int] = []
    place: list[int] = []

    def size(part: int) -> int:
        return 1 if part < terminals else length[part - terminals]

    while queue:
        times, born, pair = heapq.heappop(queue)
        now = count.get(pair, 0)
        if now < 2:
            continue
        if now != -times:
            heapq.heappush(queue, (-now, born, pair))
            continue
        a, b = pair
        made = terminals + len(left)
        fresh: dict[tuple[int, int], list[int]] = {}
        first = -1
        for i in places.pop(pair):
            if symbol[i] != a:
                continue
            j = following[i]
            if j < 0 or symbol[j] != b:
                continue
            if first < 0:
                first = i
            h, k = before[i], following[j]
            if h >= 0:
                old = (symbol[h], a)
                if old in count:
                    count[old] -= 1
                new = (symbol[h], made)
                fresh.setdefault(new, []).append(h)
            if k >= 0:
                old = (b, symbol[k])
                if old in count:
                    count[old] -= 1
                fresh.setdefault((made, symbol[k]), []).append(i)
                before[k] = i
            following[i] = k
            symbol[i], symbol[j] = made, -1
        count.pop(pair, None)
        if first < 0:
            continue
        left.append(a)
        right.append(b)
        length.append(size(a) + size(b))
        place.append(first)
        for new, found in fresh.items():
            # a neighbour may have been replaced after its place was noted
            live = [i for i in found if symbol[i] == new[0] and following[i] >= 0 and symbol[following[i]] == new[1]]
            if live:
                places[new] = live
                count[new] = len(live)
                if len(live) > 1:
                    heapq.heappush(queue, (-len(live), age, new))
                    age += 1
    roots = []
    for start, end in stretches:
        level, i = [], start
        while i >= 0:
            level.append((i, symbol[i]))
            i = following[i]
        while len(level) > 1:
            paired = []
            for (i, a), (_, b) in zip(level[::2], level[1::2]):
                paired.append((i, terminals + len(left)))
                left.append(a)
                right.append(b)
                length.append(size(a) + size(b))
                place.append(i)
            level = paired + level[len(paired) * 2 :]
        roots += level
    return Grammar(terminals, left, right, length, place, roots)


def _reach(same: np.ndarray) -> int:
    """Number of leading true values; only little more than these is looked at."""
    step, done = 64, 0
    while done < len(same):
        part = same[done : done + step]
        stop = int(part.argmin())
        if not part[stop]:
            return done + stop
        done, step = done + len(part), step * 2
    return done


def crossing_runs(
    words: np.ndarray, prefix: np.ndarray, powers: np.ndarray, start: int, middle: int, end: int, least: int, times: int
) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs inside ``[start, end)`` that have words on both sides of ``middle``.

    A run is a stretch of at least ``least`` words and ``times`` periods, as long as it can be inside the bounds.  One side
    holds at least half of its periods, so the periods to try are those by which ``times // 2`` periods on one side repeat;
    prefix hashes find them all at once and the words themselves confirm them.
    """
    half = times // 2
    most = (end - start) // times
    pivots: set[tuple[int, int]] = set()
    n = min(most, (middle - start) // half)
    if n > 0:  # the last ``half`` periods before the middle
        q = np.arange(1, n + 1)
        whole = (half - 1) * q
        later = prefix[middle] - prefix[middle - whole]
        earlier = prefix[middle - q] - prefix[middle - q - whole]
        pivots.update((q, middle) for q in (np.flatnonzero(later == earlier * powers[1 : n + 1]) + 1).tolist())
    n = min(most, (end - middle) // half)
    if n > 0:  # the first ``half`` periods after it
        q = np.arange(1, n + 1)
        whole = (half - 1) * q
        earlier = prefix[middle + whole] - prefix[middle]
        later = prefix[middle + q + whole] - prefix[middle + q]
        pivots.update((q, middle + q) for q in (np.flatnonzero(later == earlier * powers[1 : n + 1]) + 1).tolist())
    found: list[tuple[int, int, int]] = []
    seen: list[tuple[int, int]] = []
    for q, pivot in sorted(pivots):
        # the repeating periods lie inside an interval of a shorter period, which then divides this one
        low, high = (middle - half * q, middle) if pivot == middle else (middle, middle + half * q)
        if half > 1 and any(a <= low and high <= b for a, b in seen):
            continue
        # word k is the same as word k - q for all k in [low + q, high), on both sides of the pivot
        high = pivot + _reach(words[pivot:end] == words[pivot - q : end - q])
        same = words[start + q : pivot] == words[start : pivot - q]
        low = pivot - q - _reach(same[::-1])
        seen.append((low, high))
        if not (low < middle < high) or high - low < max(least, times * q):
            continue
        if not any(a <= low and high <= b for a, b, _ in found):  # else a shorter period has it
            found.append((low, high, q))
    return found


def merged(intervals: np.ndarray) -> np.ndarray:
    """Maximal (start, end, period) intervals: those of one period that overlap by a period or more are one run."""
    if not len(intervals):
        return intervals.reshape(0, 3)
    order = np.lexsort((-intervals[:, 1], intervals[:, 0], intervals[:, 2]))
    start, end, period = intervals[order].T
    kept: list[list[int]] = []
    for a, b, q in zip(start.tolist(), end.tolist(), period.tolist(), strict=True):
        if kept and kept[-1][2] == q and a <= kept[-1][1] - q:
            kept[-1][1] = max(kept[-1][1], b)
        else:
            kept.append([a, b, q])
    kept.sort(key=lambda run: (run[0], run[2]))
    return np.array(kept, dtype=np.int64)


def _stretches(words: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Stretches that can hold runs, by the counts that Re-Pair starts with.

    A pair of neighbours inside a run comes back with every period, so it occurs ``times - 1`` times or more in the text
    (a run of ``n`` words and period ``q`` has ``n - 1`` pairs, of which each ``q``-th is the same).  The text is cut where
    two neighbours occur less often.
    """
    keys = words[:-1] * np.int64(int(words.max()) + 1) + words[1:]
    _, where, often = np.unique(keys, return_inverse=True, return_counts=True)
    held = np.concatenate([[False], often[where] >= times - 1, [False]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(held))
    found = [(a, b + 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
    return [(a, b) for a, b in found if b - a >= least]


def runs(words: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """(start, end, period) of all maximal runs of a sequence of word numbers, by start, then period.

    A run is a stretch of at least ``least`` words and ``times`` of its smallest period, which no neighbouring word extends.
    The lowest nonterminal that derives all of a run has it across its boundary, so the runs across each nonterminal's
    boundary, computed once where it occurs, translated to all places where it is derived and merged, are all runs.
    """
    if times < 2 or len(words) < max(least, times):
        return np.zeros((0, 3), dtype=np.int64)
    stretches = _stretches(words, least, times)
    if not stretches:
        return np.zeros((0, 3), dtype=np.int64)
    grammar = re_pair(words, stretches)
    terminals, rules = grammar.terminals, len(grammar.left)
    with np.errstate(over="ignore"):
        value = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR)
        value = (value ^ (value >> np.uint64(29))) * np.uint64(_FACTOR)
        powers = np.full(len(words) + 1, _FACTOR, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        prefix = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(value * powers[:-1], out=prefix[1:])
        own: dict[int, list[tuple[int, int, int]]] = {}
        live = [False] * rules  # has runs of its own, or a part has
        for rule in range(rules):
            a, b = grammar.left[rule], grammar.right[rule]
            live[rule] = (a >= terminals and live[a - terminals]) or (b >= terminals and live[b - terminals])
            n = grammar.length[rule]
            if n < max(least, times):
                continue
            start = grammar.place[rule]
            middle = start + (1 if a < terminals else grammar.length[a - terminals])
            found = crossing_runs(words, prefix, powers, start, middle, start + n, least, times)
            if found:
                own[rule] = [(low - start, high - start, q) for low, high, q in found]
                live[rule] = True
    at: dict[int, list[np.ndarray]] = {}
    for place, root in grammar.roots:
        if root >= terminals and live[root - terminals]:
            at.setdefault(root - terminals, []).append(np.array([place]))
    intervals = []
    for rule in range(rules - 1, -1, -1):
        if rule not in at:
            continue
        places = np.concatenate(at.pop(rule))
        for low, high, q in own.get(rule, ()):
            intervals.append(np.column_stack([places + low, places + high, np.full(len(places), q)]))
        a, b = grammar.left[rule], grammar.right[rule]
        if a >= terminals and live[a - terminals]:
            at.setdefault(a - terminals, []).append(places)
        if b >= terminals and live[b - terminals]:
            shift = 1 if a < terminals else grammar.length[a - terminals]
            at.setdefault(b - terminals, []).append(places + shift)
    return merged(np.concatenate(intervals) if intervals else np.zeros((0, 3), dtype=np.int64))
