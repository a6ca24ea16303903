"""A character tagger: bidirectional LSTM with CRF transitions, in numpy.

Characters are mapped to classes; their one-hot vectors make the input weights a table
look-up.  Both directions run as one batched product.  Windows of a batch are padded at
the end; a mask keeps the state at zero there.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIGNS = "@.+-()_%:=/\"',[]<>#&"
CLASSES = len(SIGNS) + 8


def class_table() -> np.ndarray:
    """Class of each ASCII character; 0 pads."""
    table = np.full(128, 1, dtype=np.int64)
    table[[9, 10, 11, 12, 13]] = 2
    table[32] = 3
    table[48:58] = 4
    table[65:91] = 5
    table[97:123] = 6
    for i, c in enumerate(SIGNS):
        table[ord(c)] = 8 + i
    return table


def classes_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes < 128, class_table()[np.minimum(codes, 127)], 7)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def spread(scores: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """log(exp(scores) @ ways) of each row."""
    top = scores.max(axis=1, keepdims=True)
    return top + np.log(np.exp(scores - top) @ ways)


@dataclass
class Tagger:
    labels: int
    hidden: int = 16
    seed: int = 0
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> Tagger:
        rng = np.random.default_rng(self.seed)
        h = self.hidden
        shapes = {"x": (2, CLASSES, 4 * h), "h": (2, h, 4 * h), "b": (2, 1, 4 * h), "out": (2 * h, self.labels), "bias": (self.labels,), "move": (self.labels, self.labels)}
        self.weights = {k: rng.normal(0, 0.2, s) for k, s in shapes.items()}
        self.weights["b"][:, :, h : 2 * h] += 1.0  # remember at first
        return self

    def run(self, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Emissions (windows, positions, labels) of class ids; with `keep` the steps for `gradients`."""
        w, (n, t), size = self.weights, x.shape, self.hidden
        both = np.stack((x, x[:, ::-1]))
        masks = np.stack((mask, mask[:, ::-1]))[..., None]
        given = np.stack([w["x"][d][both[d]] for d in (0, 1)])
        h, c = np.zeros((2, n, size)), np.zeros((2, n, size))
        states, steps = np.zeros((2, n, t, size)), []
        for i in range(t):
            gates = given[:, :, i] + h @ w["h"] + w["b"]
            act = sigmoid(gates[..., : 3 * size])
            new = np.tanh(gates[..., 3 * size :])
            ins, forget, out = (act[..., k * size : (k + 1) * size] for k in range(3))
            before = (h, c)
            m = masks[:, :, i]
            c = (forget * c + ins * new) * m
            shown = np.tanh(c)
            h = out * shown * m
            states[:, :, i] = h
            if keep:
                steps.append((before, ins, forget, out, new, shown, m))
        joint = np.concatenate((states[0], states[1][:, ::-1]), axis=2)
        return joint @ w["out"] + w["bias"], [both, joint, steps]

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the labels of each window, and its gradients."""
        w, (n, t), size = self.weights, x.shape, self.hidden
        emit, (both, joint, steps) = self.run(x, mask, keep=True)
        move = w["move"]
        ways = np.exp(move)
        real = mask.astype(bool)
        ahead = np.zeros((t, n, self.labels))
        ahead[0] = emit[:, 0]
        for i in range(1, t):
            step = spread(ahead[i - 1], ways) + emit[:, i]
            ahead[i] = np.where(real[:, i, None], step, ahead[i - 1])
        total = log_sum(ahead[-1], 1)
        back = np.zeros((t, n, self.labels))
        d_move = np.zeros_like(move)
        for i in range(t - 2, -1, -1):
            after = emit[:, i + 1] + back[i + 1]
            on = real[:, i + 1, None]
            back[i] = np.where(on, spread(after, ways.T), back[i + 1])
            # The chance of each pair of labels at i and i + 1, as a product of both sides.
            left, right = ahead[i].max(1, keepdims=True), after.max(1, keepdims=True)
            weight = np.where(on, np.exp(np.where(on, left + right - total[:, None], 0)), 0)
            d_move += ((np.exp(ahead[i] - left) * weight).T @ np.exp(after - right)) * ways
        share = np.exp(ahead.transpose(1, 0, 2) + back.transpose(1, 0, 2) - total[:, None, None]) * mask[..., None]
        rows, at = np.arange(n)[:, None], np.arange(t)[None, :]
        score = (emit[rows, at, y] * mask).sum()
        follows = mask[:, 1:]
        score += (move[y[:, :-1], y[:, 1:]] * follows).sum()
        np.add.at(d_move, (y[:, :-1], y[:, 1:]), -follows)
        share[rows, at, y] -= mask
        d_emit = share / n
        grads = {"move": d_move / n, "bias": d_emit.sum((0, 1)), "out": np.einsum("nth,ntl->hl", joint, d_emit)}
        d_joint = d_emit @ w["out"].T
        d_states = np.stack((d_joint[..., :size], d_joint[:, ::-1, size:]))
        dh_next, dc_next = np.zeros((2, n, size)), np.zeros((2, n, size))
        turned = w["h"].transpose(0, 2, 1)
        d_gates = np.zeros((t, 2, n, 4 * size))
        for i in range(t - 1, -1, -1):
            (_, c0), ins, forget, out, new, shown, m = steps[i]
            dh = (d_states[:, :, i] + dh_next) * m
            dc = (dc_next + dh * out * (1 - shown**2)) * m
            step = d_gates[i]
            step[..., :size] = dc * new * ins * (1 - ins)
            step[..., size : 2 * size] = dc * c0 * forget * (1 - forget)
            step[..., 2 * size : 3 * size] = dh * shown * out * (1 - out)
            step[..., 3 * size :] = dc * ins * (1 - new**2)
            dh_next, dc_next = step @ turned, dc * forget
        # The weights' gradients are products over all steps at once.
        d_b = d_gates.sum((0, 2))[:, None]
        d_x, d_h = np.zeros_like(w["x"]), np.zeros_like(w["h"])
        for d in (0, 1):
            rows_of = d_gates[:, d].reshape(t * n, 4 * size)
            d_x[d] = (np.arange(CLASSES)[:, None] == both[d].T.reshape(1, t * n)).astype(float) @ rows_of
            d_h[d] = np.stack([s[0][0][d] for s in steps]).reshape(t * n, size).T @ rows_of
        grads |= {"x": d_x, "h": d_h, "b": d_b}
        return float((total.sum() - score) / n), grads

    def fit(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, passes: int, batch: int = 24, rate: float = 0.02) -> Tagger:
        """Adam over shuffled batches, longest windows cut to the batch's length."""
        rng = np.random.default_rng(self.seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, lengths = 0, mask.sum(1).astype(int)
        for number in range(passes):
            order = rng.permutation(len(x))
            for part in (order[i : i + batch] for i in range(0, len(x), batch)):
                t = int(lengths[part].max())
                _, grads = self.loss_and_gradients(x[part, :t], y[part, :t], mask[part, :t])
                step += 1
                speed = rate * (1 - number / passes) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grads.items():
                    g = np.clip(g, -5, 5)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] -= speed * first[k] / (np.sqrt(second[k]) + 1e-8)
        return self

    def decode(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The likeliest labels of each window (Viterbi)."""
        emit, _ = self.run(x, mask)
        n, t = x.shape
        best, came = emit[:, 0], np.zeros((t, n, self.labels), dtype=np.int8)
        own = np.broadcast_to(np.arange(self.labels), (n, self.labels))
        for i in range(1, t):
            ways = best[:, :, None] + self.weights["move"]
            on = mask[:, i, None] > 0
            came[i] = np.where(on, ways.argmax(1), own)
            best = np.where(on, ways.max(1) + emit[:, i], best)
        labels = np.zeros((n, t), dtype=np.int64)
        labels[:, -1] = best.argmax(1)
        for i in range(t - 1, 0, -1):
            labels[:, i - 1] = came[i][np.arange(n), labels[:, i]]
        return labels
