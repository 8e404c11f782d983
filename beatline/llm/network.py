"""A gated recurrent language model in numpy, with a class-factored output softmax."""

import heapq
import math
from dataclasses import dataclass
from functools import cache

import numpy as np

HIDDEN = 16
# Classes, and words of a class, are the square root of the words, 80 at most: 0.42 million weights, 1.7 MB.
MOST_WORDS = 80 * 80
WINDOW = 16
_LANES = 2048
# Lanes in training: as many as leave so many steps, between these bounds.
_STEPS, _LEAST_LANES, _MOST_LANES = 50, 16, 1024
_RATE, _CLIP = 3e-2, 1.0
# Rows of a block of logits, which stays in the cache, and the greatest logit.
_BLOCK, _MOST = 1024, 60.0


@dataclass
class Network:
    """Input ``x`` per word (already projected to the gates), recurrence ``u``, class output ``c``, word output ``w``.

    Words are numbered as given; class ``k`` has the numbers from ``k * class_words`` on.  After the last class comes one
    class for all other words, which the network does not tell apart; as inputs they share the number after the words,
    and the one after that begins a text.
    """

    x: np.ndarray
    u: np.ndarray
    c: np.ndarray
    c_bias: np.ndarray
    w: np.ndarray
    w_bias: np.ndarray

    @classmethod
    def of_counts(cls, counts: np.ndarray, others: float, hidden: int = HIDDEN) -> "Network":
        """An untrained network whose output are the shares of the counts, whatever came before."""
        side = max(1, math.ceil(math.sqrt(len(counts))))
        words = side * side
        chance = np.random.default_rng(7)
        padded = np.zeros(words)
        padded[: len(counts)] = counts
        padded = padded.reshape(side, side)
        masses = np.maximum(np.append(padded.sum(axis=1), others), 1e-4)
        with np.errstate(divide="ignore"):
            w_bias = np.maximum(np.log(padded) - np.log(masses[:-1, None]), -1e4)
        made = [
            chance.normal(0, 0.1, (words + 2, 3 * hidden)),
            chance.normal(0, hidden**-0.5, (hidden, 3 * hidden)),
            np.zeros((hidden, side + 1)),
            np.log(masses / masses.sum()),
            np.zeros((side, side, hidden)),
            w_bias,
        ]
        return cls(*(part.astype(np.float32) for part in made))

    def parts(self) -> list[np.ndarray]:
        return [self.x, self.u, self.c, self.c_bias, self.w, self.w_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts()])

    def with_flat(self, values: np.ndarray) -> "Network":
        return Network.of_flat(values, self.shapes())

    def shapes(self) -> list[tuple[int, ...]]:
        return [part.shape for part in self.parts()]

    @classmethod
    def of_flat(cls, values: np.ndarray, shapes: list[tuple[int, ...]]) -> "Network":
        parts, at = [], 0
        for shape in shapes:
            size = math.prod(shape)
            parts.append(values[at : at + size].reshape(shape).astype(np.float32))
            at += size
        return cls(*parts)

    def packed(self) -> list[np.ndarray]:
        """The parts for sending: halves of the precision, but for the biases, which are logarithms of shares."""
        return [values if i in (3, 5) else values.astype(np.float16) for i, values in enumerate(self.parts())]

    @property
    def classes(self) -> int:
        return self.w.shape[0]

    @property
    def class_words(self) -> int:
        return self.w.shape[1]

    @property
    def words(self) -> int:
        return self.w_bias.size


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.tanh(x * x.dtype.type(0.5))
    out *= x.dtype.type(0.5)
    out += x.dtype.type(0.5)
    return out


def _exponentials(states: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the logits, and their sum by row; where they overflow, no logit counts above ``_MOST``."""
    e = states @ weights
    e += bias
    with np.errstate(over="ignore"):
        np.exp(e, out=e)
    sums = e @ _ones(e.shape[1], e.dtype.char)
    if not np.isfinite(sums).all():
        e = states @ weights + bias
        np.exp(np.minimum(e, e.dtype.type(_MOST), out=e), out=e)
        sums = e.sum(axis=1)
    return e, np.maximum(sums, e.dtype.type(1e-37))


@cache
def _ones(n: int, kind: str) -> np.ndarray:
    return np.ones(n, dtype=kind)


def _by_class(targets: np.ndarray, classes_of: int, class_words: int):
    """Order of the targets by class, and (class, begin, end) of the pieces of that order, without the class of all other words."""
    order = np.argsort(targets, kind="stable")
    ends = np.searchsorted(targets[order] // class_words, np.arange(classes_of + 1))
    pieces = []
    for k in np.flatnonzero(np.diff(ends)).tolist():
        pieces += [(k, a, min(a + _BLOCK, ends[k + 1])) for a in range(ends[k], ends[k + 1], _BLOCK)]
    return order, pieces


def _step(net: Network, h: np.ndarray, ids: np.ndarray):
    n = h.shape[1]
    g, hu = net.x.take(ids, axis=0), h @ net.u
    gates = _sigmoid(g[:, : 2 * n] + hu[:, : 2 * n])
    z, r = gates[:, :n], gates[:, n:]
    new = np.tanh(g[:, 2 * n :] + r * hu[:, 2 * n :])
    return new + z * (h - new), (z, r, new, hu[:, 2 * n :])


def log_likelihoods(net: Network, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log-probability of each whole text, ``ids[bounds[i]:bounds[i + 1]]``; others count with their class only.

    Texts run side by side, longest first, so a lane ends for good when its text does; the state goes on from token to
    token until then.
    """
    lengths = np.diff(bounds)
    out = np.zeros(len(lengths))
    by_length = np.argsort(-lengths, kind="stable")
    for first in range(0, len(by_length), _LANES):
        lanes = by_length[first : first + _LANES]
        size, begin = lengths[lanes], bounds[lanes]
        total = np.zeros(len(lanes))
        h = np.zeros((len(lanes), net.u.shape[0]), dtype=np.float32)
        active = np.searchsorted(-size, -np.arange(size[0] + 1), side="left") if len(size) else []
        previous = np.full(len(lanes), net.words + 1)
        states, targets, rows, held = [], [], [], 0
        for t in range(int(size[0])):
            n = int(active[t])
            h, _ = _step(net, h[:n], previous[:n])
            previous = ids[begin[:n] + t]
            states.append(h)
            targets.append(previous)
            rows.append(np.arange(n))
            held += n
            # the output does not act on the state, so it waits until a window's worth of all lanes is there
            if held >= WINDOW * _LANES or t == size[0] - 1:
                value = _log_probabilities(net, np.concatenate(states), np.concatenate(targets))
                total += np.bincount(np.concatenate(rows), weights=value, minlength=len(lanes))
                states, targets, rows, held = [], [], [], 0
        out[lanes] = total
    return out


def _log_probabilities(net: Network, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    order, pieces = _by_class(targets, net.classes, net.class_words)
    states, targets = states.take(order, axis=0), targets.take(order)
    classes = np.minimum(targets // net.class_words, net.classes)
    share, total = np.ones(len(targets)), np.ones(len(targets))
    for a in range(0, len(targets), _BLOCK):
        block = slice(a, min(a + _BLOCK, len(targets)))
        e, sums = _exponentials(states[block], net.c, net.c_bias)
        share[block] = e[np.arange(len(e)), classes[block]]
        total[block] = sums
    value = np.log(np.maximum(share, 1e-37)) - np.log(total)
    for k, a, b in pieces:
        e, sums = _exponentials(states[a:b], net.w[k].T, net.w_bias[k])
        share[a:b] = e[np.arange(b - a), targets[a:b] % net.class_words]
        total[a:b] = sums
    ends = pieces[-1][2] if pieces else 0
    value[:ends] += np.log(np.maximum(share[:ends], 1e-37)) - np.log(total[:ends])
    out = np.empty(len(targets))
    out[order] = value
    return out


def _lanes(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Numbers of the texts in at most ``most`` lanes, longest lane first.

    Texts go by falling length to the lane that is shortest so far, and stand in their lane in a random order.
    """
    by_length = np.argsort(-lengths, kind="stable")
    lanes: list[list[int]] = [[] for _ in range(min(most, len(by_length)))]
    heap = [(0, i) for i in range(len(lanes))]
    for text in by_length.tolist():
        held, lane = heap[0]
        lanes[lane].append(text)
        heapq.heapreplace(heap, (held + int(lengths[text]), lane))
    chance = np.random.default_rng(len(by_length))
    return [chance.permutation(lanes[lane]) for _, lane in sorted(heap, reverse=True)]


class Trainer:
    """Truncated backpropagation through windows with Adam; the state, not the gradient, goes on to the next window."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.first = [np.zeros_like(part) for part in net.parts()]
        self.second = [np.zeros_like(part) for part in net.parts()]
        self.steps = 0
        # gradients of inputs and words, zero but for the rows of a step, so that a step costs the same whatever their number
        self.d_x, self.d_w, self.d_w_bias = np.zeros_like(net.x), np.zeros_like(net.w), np.zeros_like(net.w_bias)
        self.rows: list[np.ndarray | slice] = []

    def train(self, ids: np.ndarray, bounds: np.ndarray) -> int:
        """One pass over some texts; the number of tokens.

        Texts stand one after the other in lanes of about one length, so that a long text does not run alone; the state
        begins anew with each.  A text longer than a lane goes on in another, after its last word but with a new state.
        """
        lengths = np.diff(bounds)
        n = min(_MOST_LANES, max(_LEAST_LANES, int(lengths.sum()) // (WINDOW * _STEPS)))
        most = max(WINDOW, -(-int(lengths.sum()) // n))
        pieces = -(-lengths // most)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(bounds[:-1], pieces) + within * most
        lengths = np.minimum(most, np.repeat(bounds[1:], pieces) - start)
        if not len(lengths):
            return 0
        enters = np.where(within > 0, ids[start - 1], self.net.words + 1)
        lanes = _lanes(lengths, n)
        order = np.concatenate(lanes)
        size = np.array([lengths[lane].sum() for lane in lanes])
        ends = np.cumsum(lengths[order])
        entered = np.full(ends[-1], -1)
        entered[ends - lengths[order]] = enters[order]
        moved = np.repeat(start[order] - (ends - lengths[order]), lengths[order])
        self._group(ids[moved + np.arange(ends[-1])], np.cumsum(size) - size, size, entered)
        return int(ends[-1])

    def _group(self, ids: np.ndarray, begin: np.ndarray, size: np.ndarray, entered: np.ndarray | None = None) -> None:
        """Lanes side by side, longest first; ``entered`` has the input where a new state begins, and -1 elsewhere."""
        net = self.net
        h = np.zeros((len(size), net.u.shape[0]), dtype=np.float32)
        active = np.searchsorted(-size, -np.arange(size[0] + 1), side="left")
        previous = np.full(len(size), net.words + 1)
        for start in range(0, int(size[0]), WINDOW):
            trace = []
            for t in range(start, min(start + WINDOW, int(size[0]))):
                n = int(active[t])
                before, inputs = h[:n], previous[:n]
                enter = entered[begin[:n] + t] if entered is not None else np.full(n, -1)
                fresh = np.flatnonzero(enter >= 0)
                if len(fresh):
                    before, inputs = before.copy(), inputs.copy()
                    before[fresh], inputs[fresh] = 0, enter[fresh]
                h, cache = _step(net, before, inputs)
                previous = ids[begin[:n] + t]
                trace.append((before, inputs, cache, h, previous, fresh))
            self._learn(trace)

    def _learn(self, trace: list[tuple]) -> None:
        net = self.net
        states = np.concatenate([x[3] for x in trace])
        targets = np.concatenate([x[4] for x in trace])
        scale = states.dtype.type(1 / len(targets))
        order, pieces = _by_class(targets, net.classes, net.class_words)
        by_class, targets_by = states.take(order, axis=0), targets.take(order)
        classes_by = np.minimum(targets_by // net.class_words, net.classes)
        d_by_class = np.empty_like(by_class)
        d_c, d_c_bias = np.zeros_like(net.c), np.zeros_like(net.c_bias)
        for a in range(0, len(targets), _BLOCK):
            block = slice(a, min(a + _BLOCK, len(targets)))
            e, sums = _exponentials(by_class[block], net.c, net.c_bias)
            e *= (scale / sums)[:, None]
            e[np.arange(len(e)), classes_by[block]] -= scale
            d_by_class[block] = e @ net.c.T
            d_c += by_class[block].T @ e
            d_c_bias += e.sum(axis=0)
        for k, a, b in pieces:
            e, sums = _exponentials(by_class[a:b], net.w[k].T, net.w_bias[k])
            e *= (scale / sums)[:, None]
            e[np.arange(b - a), targets_by[a:b] % net.class_words] -= scale
            self.d_w[k] += e.T @ by_class[a:b]
            self.d_w_bias[k] += e.sum(axis=0)
            d_by_class[a:b] += e @ net.w[k]
        d_states = np.empty_like(d_by_class)
        d_states[order] = d_by_class
        d_u = np.zeros_like(net.u)
        classes = sorted({k for k, _, _ in pieces})
        end = len(targets)
        d_next = np.zeros((0, net.u.shape[0]), dtype=np.float32)
        inputs_all, d_inputs = [], []
        for before, inputs, (z, r, new, hu), _, _, fresh in reversed(trace):
            n = len(inputs)
            d_h = d_states[end - n : end].copy()
            end -= n
            d_h[: len(d_next)] += d_next
            d_new = d_h * (1 - z) * (1 - new * new)
            d_z = d_h * (before - new) * z * (1 - z)
            d_r = d_new * hu * r * (1 - r)
            d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_u += before.T @ d_hu
            d_next = d_h * z + d_hu @ net.u.T
            d_next[fresh] = 0
            inputs_all.append(inputs)
            d_inputs.append(np.concatenate([d_z, d_r, d_new], axis=1))
        touched = self._add_rows(self.d_x, np.concatenate(inputs_all), np.concatenate(d_inputs))
        every = slice(None)
        # where most classes occur, all are brought up to date, which spares copies
        known = np.array(classes, dtype=np.int64) if 2 * len(classes) < net.classes else every
        self.rows = [touched, every, every, every, known, known]
        self._update([self.d_x, d_u, d_c, d_c_bias, self.d_w, self.d_w_bias])

    @staticmethod
    def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        into[rows[first]] = np.add.reduceat(values.take(order, axis=0), first, axis=0)
        return rows[first]

    def _update(self, grads: list[np.ndarray]) -> None:
        """Adam on the rows of this step; the others keep their weights and averages."""
        self.steps += 1
        parts = [grad[rows] for grad, rows in zip(grads, self.rows, strict=True)]
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in parts))
        clip = np.float32(min(1.0, _CLIP / max(norm, 1e-12)))
        rate = np.float32(_RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps))
        for part, whole, grad, m, v, rows in zip(self.net.parts(), grads, parts, self.first, self.second, self.rows, strict=True):
            first, second = m[rows], v[rows]
            # in place: slices are views, chosen rows are copies that go back
            step = grad * clip
            square = step * step
            step -= first
            step *= np.float32(0.1)
            first += step
            square -= second
            square *= np.float32(0.001)
            second += square
            np.sqrt(second, out=square)
            square += np.float32(1e-8)
            np.divide(first, square, out=square)
            square *= rate
            if isinstance(rows, slice):
                part -= square
            else:
                m[rows], v[rows] = first, second
                part[rows] -= square
            whole[rows] = 0
