"""A small gated recurrent language model in numpy, with a class-factored softmax.

``P(token | past) = P(class | state) * P(token | class, state)``.  The state is that of
a gated recurrent unit.  Classes of frequent tokens have a softmax of their own over
their members; what a token of another class costs within it is for the caller to add.

All parameters lie in one vector, so models can be averaged and sent as bytes.
"""

from __future__ import annotations

import heapq

import numpy as np


def _order(numbers: np.ndarray, n: int) -> np.ndarray:
    """A stable order of numbers below ``n``; small ones are sorted by their digits."""
    return np.argsort(numbers.astype(np.int16) if n < 1 << 15 else numbers, kind="stable")


class GRU:
    """Tokens 0 .. n_inputs - 1 go in (the last one begins a text); classes come out.

    ``members``: how many members each class has that are told apart by the state (0:
    none).  Class and member biases start as given logs of frequencies, all else near
    zero, so an untrained model predicts the frequencies whatever the past.
    """

    def __init__(self, n_inputs: int, members: list[int], hidden: int = 16):
        self.members = np.array(members, np.int64)
        self.hidden = h = hidden
        self.sizes = {"x": (n_inputs, 3 * h), "u": (h, 3 * h), "un": (h,), "wc": (h, len(members)), "bc": (len(members),)}
        total = int(self.members.sum())
        self.sizes |= {"wm": (h, total), "bm": (total,)}
        self.is_member = np.arange(max(members, default=0)) < self.members[:, None]
        self.n = sum(int(np.prod(s)) for s in self.sizes.values())

    def views(self, vector: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.sizes.items():
            n = int(np.prod(shape))
            out[name] = vector[at : at + n].reshape(shape)
            at += n
        return out

    def start(self, class_logs: np.ndarray, member_logs: np.ndarray, seed: int = 0) -> np.ndarray:
        rng = np.random.default_rng(seed)
        vector = np.zeros(self.n, np.float32)
        p = self.views(vector)
        p["x"][:] = rng.normal(0, 0.3, p["x"].shape)
        p["u"][:] = rng.normal(0, 0.5 / np.sqrt(self.hidden), p["u"].shape)
        p["bc"][:], p["bm"][:] = class_logs, member_logs
        return vector

    def _states(self, p, inputs, h, keep=None):
        """States after each of the inputs, (time, unit, lane); ``h`` is (unit, lane).

        Lanes lie last, so gates are whole stretches of memory.  With ``keep`` (arrays for
        states before, gates, candidates' parts and candidates), also what the way back needs.
        """
        size = self.hidden
        alive = (inputs != len(p["x"]) - 1).astype(np.float32)  # a text that begins forgets
        states = np.empty((len(inputs), size, inputs.shape[1]), np.float32)
        x = np.ascontiguousarray(p["x"][inputs].transpose(0, 2, 1))
        u, un = np.ascontiguousarray(p["u"].T), p["un"][:, None]
        for t in range(len(inputs)):
            h = h * alive[t]
            a = u @ h
            g = a[: 2 * size]
            g += x[t, : 2 * size]
            np.negative(g, out=g)
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            c = a[2 * size :]
            c += un
            n = g[size:] * c
            n += x[t, 2 * size :]
            np.tanh(n, out=n)
            if keep is not None:
                keep[0][t], keep[1][t], keep[2][t] = h, a, n
            h = h - n
            h *= g[:size]
            h += n
            states[t] = h
        return states, h

    @staticmethod
    def _lowered(states, weights, biases) -> np.ndarray:
        """Logits less a bound that keeps their exponentials from overflow."""
        logits = states @ weights
        logits += biases
        # states lie between -1 and 1, which bounds all logits; far bounds need each row's own
        reach = np.abs(weights).sum(axis=0)
        top = (biases + reach).max()
        if top - (biases - reach).max() > 60:
            top = logits.max(axis=1, keepdims=True)
        logits -= top
        return logits

    def _softmax(self, states, weights, biases) -> np.ndarray:
        shares = self._lowered(states, weights, biases)
        np.exp(shares, out=shares)
        shares /= (shares @ np.ones(shares.shape[1], shares.dtype))[:, None]
        return shares

    def _log_picked(self, states, weights, biases, picked: np.ndarray) -> np.ndarray:
        """Of each row's softmax, the log of the probability picked."""
        logits = self._lowered(states, weights, biases)
        found = logits[np.arange(len(logits)), picked]
        total = np.exp(logits, out=logits) @ np.ones(logits.shape[1], logits.dtype)
        return found - np.log(total)

    def _within(self, p, flat, classes):
        """Logits within the classes, of the rows whose class has members, by class.

        Returns the rows, their states, the logits (less a bound; of members that a class
        lacks minus infinity), the weights by class, and each class's stretch of rows.
        """
        order = _order(classes, len(self.members))
        sorted_ = classes[order]
        held = (sorted_ >= 0) & (self.members[sorted_] > 0)
        order, sorted_ = order[held], sorted_[held]
        used, starts = np.unique(sorted_, return_index=True)
        stretches = list(zip(used.tolist(), starts.tolist(), np.append(starts, len(order))[1:].tolist()))
        weights = np.zeros((*self.is_member.shape, self.hidden), np.float32)
        weights[self.is_member] = p["wm"].T
        reach = np.abs(weights).sum(axis=2)
        low, top = np.full((2, *self.is_member.shape), -np.inf, np.float32)
        low[self.is_member], top[self.is_member] = p["bm"] - reach[self.is_member], p["bm"] + reach[self.is_member]
        biases = np.full(self.is_member.shape, -np.inf, np.float32)
        biases[self.is_member] = p["bm"]
        bound = top.max(axis=1, initial=-np.inf)
        # states lie between -1 and 1, which bounds all logits; far bounds need each row's own
        far = (bound[used] - low.max(axis=1, initial=-np.inf)[used] > 60).any()
        if not far:
            biases[used] -= bound[used][:, None]
        weights = np.ascontiguousarray(weights.transpose(0, 2, 1))
        mine, logits = flat[order], np.empty((len(order), biases.shape[1]), np.float32)
        for k, i, j in stretches:
            np.matmul(mine[i:j], weights[k], out=logits[i:j])
        logits += biases[sorted_]
        if far:
            logits -= logits.max(axis=1, keepdims=True)
        return order, mine, logits, weights, stretches

    def logs(self, vector, inputs, classes, places, h):
        """Natural logs of the probabilities of the targets, and the last state.

        All arrays are (time, lane); a class of -1 is padding and gets 0.
        """
        p = self.views(vector)
        states, h = self._states(p, inputs, np.ascontiguousarray(h.T))
        flat = states.transpose(0, 2, 1).reshape(-1, self.hidden)
        classes, places = classes.ravel(), places.ravel()
        out = self._log_picked(flat, p["wc"], p["bc"], classes)
        who, _, logits, _, _ = self._within(p, flat, classes)
        found = logits[np.arange(len(who)), places[who]] if len(who) else np.zeros(0, np.float32)
        out[who] += found - np.log(np.exp(logits, out=logits).sum(axis=1))
        out[classes < 0] = 0
        return out.reshape(inputs.shape), h.T

    def gradient(self, vector, inputs, classes, places, h):
        """Gradient of a window's loss over its cells, by truncated backpropagation; last state."""
        p, grad, size = self.views(vector), np.zeros_like(vector), self.hidden
        d = self.views(grad)
        shape = (len(inputs), size, inputs.shape[1])
        before, n = np.empty((2, *shape), np.float32)
        gates = np.empty((shape[0], 3 * size, shape[2]), np.float32)
        states, last = self._states(p, inputs, np.ascontiguousarray(h.T), (before, gates, n))
        flat = states.transpose(0, 2, 1).reshape(-1, size)
        classes, places = classes.ravel(), places.ravel()
        rows = np.flatnonzero(classes >= 0)
        if not len(rows):
            return grad, last.T
        scale = np.float32(1 / inputs.size)  # a window that is mostly padding moves little
        dlogits = self._softmax(flat, p["wc"], p["bc"])
        dlogits[rows, classes[rows]] -= 1
        if len(rows) < len(classes):
            dlogits[classes < 0] = 0
        dlogits *= scale
        d["wc"][:], d["bc"][:] = flat.T @ dlogits, np.ones(len(dlogits), np.float32) @ dlogits
        dflat = dlogits @ p["wc"].T
        who, mine, dm, weights, stretches = self._within(p, flat, classes)
        if len(who):
            np.exp(dm, out=dm)
            dm *= (scale / (dm @ np.ones(dm.shape[1], np.float32)))[:, None]
            dm[np.arange(len(who)), places[who]] -= scale
            back, dw, db = np.empty_like(mine), np.zeros_like(weights), np.zeros(self.is_member.shape, np.float32)
            for k, i, j in stretches:
                np.matmul(mine[i:j].T, dm[i:j], out=dw[k])
                np.matmul(dm[i:j], weights[k].T, out=back[i:j])
            db[[k for k, _, _ in stretches]] = np.add.reduceat(dm, [i for _, i, _ in stretches], axis=0)
            d["wm"][:], d["bm"][:] = dw.transpose(0, 2, 1)[self.is_member].T, db[self.is_member]
            dflat[who] += back
        dstates = np.ascontiguousarray(dflat.reshape(shape[0], shape[2], size).transpose(0, 2, 1))
        begin = len(p["x"]) - 1
        alive = (inputs != begin).astype(np.float32)
        z, r, c = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        by_n, by_z, by_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), c * r * (1 - r)
        dx, da = np.empty_like(gates), np.empty_like(gates)
        dh = np.zeros(shape[1:], np.float32)
        for t in range(len(inputs) - 1, -1, -1):
            dh += dstates[t]
            dn = dx[t, 2 * size :]
            np.multiply(dh, by_n[t], out=dn)
            np.multiply(dh, by_z[t], out=da[t, :size])
            np.multiply(dn, by_r[t], out=da[t, size : 2 * size])
            np.multiply(dn, r[t], out=da[t, 2 * size :])
            dh *= z[t]
            dh += p["u"] @ da[t]
            dh *= alive[t]
        dx[:, : 2 * size] = da[:, : 2 * size]
        d["u"][:] = (before @ da.transpose(0, 2, 1)).sum(axis=0)
        d["un"][:] = da[:, 2 * size :].sum(axis=(0, 2))
        flat_inputs = inputs.ravel()
        order = _order(flat_inputs, len(p["x"]))
        ordered = flat_inputs[order]
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        d["x"][ordered[starts]] = np.add.reduceat(dx.transpose(0, 2, 1).reshape(-1, 3 * size)[order], starts, axis=0)
        return grad, last.T


def lanes(lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lane and begin of each sequence when all are laid end to end in ``n`` lanes, and the
    lanes' heights.

    Longest first, each to the lane that is shortest so far.  Lanes are numbered from the
    highest to the lowest, so those in use at any row are the first ones.
    """
    lane, begin = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    heap = [(0, k) for k in range(n)]
    for i in np.argsort(-lengths, kind="stable"):
        at, k = heap[0]
        lane[i], begin[i] = k, at
        heapq.heapreplace(heap, (at + int(lengths[i]), k))
    heights, number = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, (at, k) in enumerate(sorted(heap, reverse=True)):
        heights[i], number[k] = at, i
    return number[lane], begin, heights


def laid_out(lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences given end to end: each element's row and lane, and the lanes' heights."""
    lane, begin, heights = lanes(lengths, n)
    row = np.arange(int(lengths.sum()))
    row += np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)
    return row, np.repeat(lane.astype(np.int32), lengths), heights


class Adam:
    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n, np.float32), np.zeros(n, np.float32), 0, rate

    def step(self, vector: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        rate = self.rate * min(1.0, self.t / 30)  # a slow start
        rate *= np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        vector -= np.float32(rate) * self.m / (np.sqrt(self.v) + np.float32(1e-6))
