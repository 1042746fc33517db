"""A gated recurrent layer in numpy: forward, and backward through time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def logistic(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


@dataclass
class Trace:
    """What the backward pass needs of each step."""

    before: np.ndarray
    gates: np.ndarray
    new: np.ndarray
    inner: np.ndarray


def step(inputs: np.ndarray, state: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One step: ``inputs`` (rows, 3 width) hold the input's part of reset gate, update gate and new value."""
    width = state.shape[1]
    inner = state @ weights
    gates = logistic(inputs[:, : 2 * width] + inner[:, : 2 * width])
    new = np.tanh(inputs[:, 2 * width :] + gates[:, :width] * inner[:, 2 * width :])
    return new + gates[:, width:] * (state - new), gates, new, inner[:, 2 * width :]


def forward(inputs: np.ndarray, state: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """States after each step of ``inputs`` (steps, rows, 3 width)."""
    states = np.empty((*inputs.shape[:2], state.shape[1]), dtype=np.float32)
    for t in range(len(inputs)):
        state = step(inputs[t], state, weights)[0]
        states[t] = state
    return states


def traced(inputs: np.ndarray, state: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, Trace]:
    steps, rows, _ = inputs.shape
    width = state.shape[1]
    states, new, inner, before = (np.empty((steps, rows, width), dtype=np.float32) for _ in range(4))
    gates = np.empty((steps, rows, 2 * width), dtype=np.float32)
    for t in range(steps):
        before[t] = state
        state, gates[t], new[t], inner[t] = step(inputs[t], state, weights)
        states[t] = state
    return states, Trace(before, gates, new, inner)


def backward(errors: np.ndarray, trace: Trace, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of the weights, from those of the states; cut at the first step."""
    steps, rows, width = errors.shape
    into = np.empty((steps, rows, 3 * width), dtype=np.float32)
    gradient = np.zeros_like(weights)
    carried = np.zeros((rows, width), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        error = errors[t] + carried
        reset, update = trace.gates[t][:, :width], trace.gates[t][:, width:]
        new, before, inner = trace.new[t], trace.before[t], trace.inner[t]
        d_new = error * (1 - update) * (1 - new * new)
        d_update = error * (before - new) * update * (1 - update)
        d_reset = d_new * inner * reset * (1 - reset)
        into[t, :, :width], into[t, :, width : 2 * width], into[t, :, 2 * width :] = d_reset, d_update, d_new
        through = np.concatenate([d_reset, d_update, d_new * reset], axis=1)
        gradient += before.T @ through
        carried = error * update + through @ weights.T
    return into, gradient


def _signs(width: int) -> np.ndarray:
    return np.repeat(np.array([-1, -1, 1], dtype=np.float32), width)


def word_table(embed: np.ndarray, into: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Each word's part of the new value, and of the gates with the sign turned: (words, 3 width)."""
    return (embed @ into + bias) * _signs(len(bias) // 3)


def forward_words(words: np.ndarray, table: np.ndarray, state: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """States after each step, with a one behind each: (steps, rows, width + 1), of ``words`` (steps, rows), by their rows of ``table``."""
    (steps, rows), width, one = words.shape, state.shape[1], np.float32(1)
    across = weights * _signs(width)
    states = np.ones((steps, rows, width + 1), dtype=np.float32)
    product, own = (np.empty((rows, 3 * width), dtype=np.float32) for _ in range(2))
    gate, new = np.empty((rows, 2 * width), dtype=np.float32), np.empty((rows, width), dtype=np.float32)
    # An exponential that overflows makes a gate zero.
    with np.errstate(over="ignore"):
        for t in range(steps):
            after = states[t, :, :width]
            np.matmul(state, across, out=product)
            table.take(words[t], axis=0, out=own, mode="clip")
            np.add(own[:, : 2 * width], product[:, : 2 * width], out=gate)
            np.exp(gate, out=gate)
            gate += one
            np.reciprocal(gate, out=gate)
            np.multiply(gate[:, :width], product[:, 2 * width :], out=new)
            new += own[:, 2 * width :]
            np.tanh(new, out=new)
            np.subtract(state, new, out=after)
            after *= gate[:, width:]
            after += new
            state = after
    return states


class Columns:
    """The same layer where many sequences go side by side: arrays are (steps, width, rows), so that each gate is one block."""

    @staticmethod
    def projected(inputs: np.ndarray, into: np.ndarray, bias: np.ndarray | None = None) -> np.ndarray:
        """The input's part of the new value, and of the gates with the sign turned, (steps, 3 width, rows), of inputs (steps, rows, depth).

        Without a ``bias`` the last row of ``into`` is it, and inputs end with a one.
        """
        sign = _signs(into.shape[1] // 3)
        found = np.matmul((into * sign).T, inputs.transpose(0, 2, 1))
        if bias is not None:
            found += (bias * sign)[:, None]
        return found

    @staticmethod
    def traced(inputs: np.ndarray, state: np.ndarray, weights: np.ndarray, keep: bool = True) -> tuple[np.ndarray, Trace]:
        """States after each step of ``projected`` inputs, and what the backward pass needs (without ``keep`` of the last step only).

        ``state`` is (width, rows).
        """
        steps, _, rows = inputs.shape
        width = len(state)
        across = np.ascontiguousarray(weights.T)
        across[: 2 * width] *= -1
        states = np.empty((steps + 1, width, rows), dtype=np.float32)
        states[0], one = state, np.float32(1)
        products, gates, fresh = (np.empty((steps if keep else 1, k * width, rows), dtype=np.float32) for k in (3, 2, 1))
        # An exponential that overflows makes a gate zero.
        with np.errstate(over="ignore"):
            for t in range(steps):
                at = t if keep else 0
                product, gate, new, after = products[at], gates[at], fresh[at], states[t + 1]
                np.matmul(across, states[t], out=product)
                np.add(inputs[t, : 2 * width], product[: 2 * width], out=gate)
                np.exp(gate, out=gate)
                gate += one
                np.reciprocal(gate, out=gate)
                np.multiply(gate[:width], product[2 * width :], out=new)
                new += inputs[t, 2 * width :]
                np.tanh(new, out=new)
                np.subtract(states[t], new, out=after)
                after *= gate[width:]
                after += new
        return states[1:], Trace(states[:-1], gates, fresh, products[:, 2 * width :])

    @staticmethod
    def backward(errors: np.ndarray, trace: Trace, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the inputs and of the weights, from those of the states; cut at the first step."""
        steps, width, rows = errors.shape
        into = np.empty((steps, 3 * width, rows), dtype=np.float32)
        gradient = np.zeros((3 * width, width), dtype=np.float32)
        through = np.empty((3 * width, rows), dtype=np.float32)
        carried, error, left, kept = (np.zeros((width, rows), dtype=np.float32) for _ in range(4))
        for t in range(steps - 1, -1, -1):
            reset, update = trace.gates[t, :width], trace.gates[t, width:]
            new, before = trace.new[t], trace.before[t]
            d_reset, d_update, d_new = into[t, :width], into[t, width : 2 * width], into[t, 2 * width :]
            np.add(errors[t], carried, out=error)
            np.subtract(np.float32(1), update, out=left)
            left *= error
            np.multiply(new, new, out=kept)
            np.subtract(np.float32(1), kept, out=kept)
            np.multiply(left, kept, out=d_new)
            np.subtract(before, new, out=kept)
            kept *= update
            np.multiply(left, kept, out=d_update)
            through[width : 2 * width] = d_update
            inner = through[2 * width :]
            np.multiply(d_new, reset, out=inner)
            np.subtract(np.float32(1), reset, out=kept)
            kept *= inner
            np.multiply(kept, trace.inner[t], out=d_reset)
            through[:width] = d_reset
            gradient += through @ before.T
            np.matmul(weights, through, out=carried)
            error *= update
            carried += error
        return into, gradient.T


class Adagrad:
    """Parameters by name, each with its sum of squared gradients; rows of tables may be updated alone."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.parameters, self.rate = parameters, rate
        self.squares = {k: np.full_like(v, 1e-4) for k, v in parameters.items()}
        self.scratch: dict[str, np.ndarray] = {}

    def apply(self, gradients: dict[str, np.ndarray], limit: float = 5.0) -> None:
        """Changes the gradients as well."""
        for name, gradient in gradients.items():
            if not -limit <= gradient.min() <= gradient.max() <= limit:
                np.clip(gradient, -limit, limit, out=gradient)
            squares, roots = self.squares[name], self.scratch.setdefault(name, np.empty_like(self.squares[name]))
            np.multiply(gradient, gradient, out=roots)
            squares += roots
            np.sqrt(squares, out=roots)
            gradient *= self.rate
            gradient /= roots
            self.parameters[name] -= gradient

    def apply_rows(self, name: str, rows: np.ndarray, gradient: np.ndarray) -> None:
        """``gradient[i]`` is of row ``rows[i]``, which may repeat."""
        if not len(rows):
            return
        # Numbers of 16 bits are sorted by radix.
        rows = rows.astype(np.uint16) if len(self.parameters[name]) <= 1 << 16 else rows
        order = np.argsort(rows, kind="stable")
        ordered = rows[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        found = ordered[first]
        total = np.add.reduceat(gradient.take(order, axis=0), first, axis=0)
        squares = self.squares[name].take(found, axis=0)
        squares += total * total
        self.squares[name][found] = squares
        self.parameters[name][found] = self.parameters[name].take(found, axis=0) - self.rate * total / np.sqrt(squares)
