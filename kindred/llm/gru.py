"""A gated recurrent language model in NumPy: class-factored softmax, truncated backpropagation.

Tokens are numbers: ``WORDS`` frequent words, the end of a text, and one number for all other words (the tail).
Every frequent word and the end belong to a class of ``CLASS_SIZE``; the tail is a class of its own. The model
gives the probability of the class, and within a class that of the word.

Texts lie one after another in lanes that run in step. The state goes on from window to window, and is
zero where a text begins, so a text is scored as a whole however long it is.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

HIDDEN = 16
CLASS_SIZE = 32
CLASSES = 32
WORDS = CLASSES * CLASS_SIZE - 1
END = WORDS
TAIL = WORDS + 1
LANES = 256
#: Steps of truncated backpropagation.
WINDOW = 32

SHAPES = {
    "x": (TAIL + 1, 3 * HIDDEN),
    "u": (HIDDEN, 3 * HIDDEN),
    "wc": (HIDDEN, CLASSES + 1),
    "bc": (CLASSES + 1,),
    "wo": (CLASSES, HIDDEN, CLASS_SIZE),
    "bo": (CLASSES, CLASS_SIZE),
}
Weights = dict[str, np.ndarray]


def initial(counts: np.ndarray) -> Weights:
    """Small weights, and biases that give the frequencies; ``counts`` has every token's (the tail's last)."""
    draw = np.random.default_rng(7)
    weights = {name: draw.normal(0, 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()}
    weights["x"][:, :HIDDEN] += 1.0  # the state starts out as slow to change
    counts = counts.astype(np.float64) + 0.01
    groups = counts[:-1].reshape(CLASSES, CLASS_SIZE)
    of_class = np.append(groups.sum(axis=1), counts[-1])
    weights["bc"] = np.log(of_class / of_class.sum()).astype(np.float32)
    weights["bo"] = np.log(groups / groups.sum(axis=1, keepdims=True)).astype(np.float32)
    return weights


def to_bytes(weights: Weights) -> bytes:
    return np.concatenate([weights[name].ravel() for name in SHAPES]).astype(np.float32).tobytes()


def from_vector(vector: np.ndarray) -> Weights:
    weights, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        weights[name] = vector[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return weights


def in_lanes(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts ``ids[first[i]:first[i + 1]]`` (each ends with ``END``) laid out in lanes of about one length.

    Gives a matrix of steps by lanes (-1 where a lane is over), and the step and lane of every token.
    """
    lengths = np.diff(first)
    width = int(np.clip(lengths.sum() // max(lengths.max(), 1), 1, LANES))
    ends = [(0, lane) for lane in range(width)]
    begin, lane_of = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        length, lane = ends[0]
        begin[i], lane_of[i] = length, lane
        heapq.heapreplace(ends, (length + int(lengths[i]), lane))
    steps = np.arange(len(ids)) - np.repeat(first[:-1], lengths) + np.repeat(begin, lengths)
    lanes = np.repeat(lane_of, lengths)
    matrix = np.full((max(length for length, _ in ends), width), -1, dtype=np.int32)
    matrix[steps, lanes] = ids
    return matrix, steps, lanes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Cells:
    """The states of a window, kept for going back."""

    def __init__(self, weights: Weights, inputs: np.ndarray, state: np.ndarray):
        steps, lanes = inputs.shape
        x, u, h = weights["x"], weights["u"], HIDDEN
        self.inputs = inputs
        self.before = np.empty((steps, lanes, h), np.float32)
        self.gates = np.empty((steps, lanes, 2 * h), np.float32)
        self.inner = np.empty((steps, lanes, h), np.float32)
        self.new = np.empty((steps, lanes, h), np.float32)
        self.after = np.empty((steps, lanes, h), np.float32)
        fed = x[inputs]
        self.goes_on = (inputs != END).astype(np.float32)[:, :, None]
        for t in range(steps):
            state = state * self.goes_on[t]
            mixed = state @ u
            gates = _sigmoid(fed[t, :, : 2 * h] + mixed[:, : 2 * h])
            new = np.tanh(fed[t, :, 2 * h :] + gates[:, h:] * mixed[:, 2 * h :])
            self.before[t], self.gates[t], self.inner[t], self.new[t] = state, gates, mixed[:, 2 * h :], new
            state = new + gates[:, :h] * (state - new)
            self.after[t] = state
        self.state = state

    def gradients(self, weights: Weights, from_output: np.ndarray) -> Weights:
        """Of the recurrent weights, given those of the states; nothing goes back beyond the window."""
        steps, lanes, h = self.after.shape
        into_u = np.empty((steps, lanes, 3 * h), np.float32)
        into_x = np.empty((steps, lanes, 3 * h), np.float32)
        back, turned = np.zeros((lanes, h), np.float32), np.ascontiguousarray(weights["u"].T)
        # What does not depend on the steps after is worked out for all steps at once.
        z, r = self.gates[:, :, :h], self.gates[:, :, h:]
        shut = 1 - z
        of_z = (self.before - self.new) * z * shut
        of_new = shut * (1 - self.new * self.new)
        of_r = self.inner * r * (1 - r)
        for t in reversed(range(steps)):
            grad = from_output[t] + back
            d_new = grad * of_new[t]
            x_t, u_t = into_x[t], into_u[t]
            np.multiply(grad, of_z[t], out=x_t[:, :h])
            np.multiply(d_new, of_r[t], out=x_t[:, h : 2 * h])
            x_t[:, 2 * h :] = d_new
            u_t[:, : 2 * h] = x_t[:, : 2 * h]
            np.multiply(d_new, r[t], out=u_t[:, 2 * h :])
            back = (grad * z[t] + u_t @ turned) * self.goes_on[t]
        flat = into_u.reshape(-1, 3 * h)
        d_x = np.zeros_like(weights["x"])
        order = np.argsort(self.inputs.ravel(), kind="stable")
        tokens, starts = np.unique(self.inputs.ravel()[order], return_index=True)
        d_x[tokens] = np.add.reduceat(into_x.reshape(-1, 3 * h)[order], starts)
        return {"x": d_x, "u": self.before.reshape(-1, h).T @ flat}


def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The logarithm of each row's sum of exponentials, and the probabilities."""
    most = logits.max() if logits.size else np.float32(0)
    powers = np.exp(logits - most)
    sums = powers @ np.ones(logits.shape[1], np.float32)
    if sums.size and sums.min() < 1e-30:  # rows far below the greatest value: each by its own
        most = logits.max(axis=1, keepdims=True)
        powers = np.exp(logits - most)
        sums = powers.sum(axis=1)
        most = most[:, 0]
    return np.log(sums) + most, powers / sums[:, None]


def output(weights: Weights, states: np.ndarray, targets: np.ndarray, learn: bool) -> tuple[np.ndarray, Weights]:
    """Log-probability of each target (0 for -1) and, to learn, the gradients of the loss.

    Under the key ``state`` are those of the states. Of the tail only the class counts here.
    """
    there = np.flatnonzero(targets >= 0)
    known, wanted = states[there], targets[there]
    classes = wanted // CLASS_SIZE
    rows = np.arange(len(there))
    logits = known @ weights["wc"] + weights["bc"]
    total, d_class = _softmax(logits)
    found = logits[rows, classes] - total
    grads: Weights = {}
    if learn:
        d_class[rows, classes] -= 1
        d_known = d_class @ weights["wc"].T
        grads = {"wc": known.T @ d_class, "bc": d_class.sum(axis=0),
                 "wo": np.zeros_like(weights["wo"]), "bo": np.zeros_like(weights["bo"])}
    order = np.argsort(classes, kind="stable")
    ends = np.searchsorted(classes[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        own = order[ends[c] : ends[c + 1]]
        if not len(own):
            continue
        word, here = wanted[own] % CLASS_SIZE, np.arange(len(own))
        mine = known[own]
        logits = mine @ weights["wo"][c] + weights["bo"][c]
        total, d_word = _softmax(logits)
        found[own] += logits[here, word] - total
        if learn:
            d_word[here, word] -= 1
            d_known[own] += d_word @ weights["wo"][c].T
            grads["wo"][c], grads["bo"][c] = mine.T @ d_word, d_word.sum(axis=0)
    log_probability = np.zeros(len(targets), np.float32)
    log_probability[there] = found
    if learn:
        grads["state"] = np.zeros_like(states)
        grads["state"][there] = d_known
    return log_probability, grads


def windows(matrix: np.ndarray, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Inputs and targets of each window: the token before (``END`` before the first), and the token."""
    before = np.concatenate([np.full((1, matrix.shape[1]), END, np.int32), matrix[:-1]])
    before[before < 0] = END
    for at in range(0, len(matrix), steps):
        yield before[at : at + steps], matrix[at : at + steps]


def score(weights: Weights, ids: np.ndarray, first: np.ndarray, steps: int = 2 * WINDOW) -> np.ndarray:
    """The natural logarithm of the probability of each text; of words in the tail only that of the tail."""
    matrix, at_step, at_lane = in_lanes(ids, first)
    found = np.empty(matrix.shape, np.float32)
    state = np.zeros((matrix.shape[1], HIDDEN), np.float32)
    for i, (inputs, targets) in enumerate(windows(matrix, steps)):
        cells = Cells(weights, inputs, state)
        state = cells.state
        logs, _ = output(weights, cells.after.reshape(-1, HIDDEN), targets.ravel(), learn=False)
        found[i * steps : i * steps + len(targets)] = logs.reshape(targets.shape)
    return np.add.reduceat(found[at_step, at_lane].astype(np.float64), first[:-1])


class Trainer:
    """Adam over windows of truncated backpropagation."""

    def __init__(self, weights: Weights, rate: float):
        self.weights = {name: value.copy() for name, value in weights.items()}
        self.rate, self.step, self.tokens = rate, 0, 0
        self.mean = {name: np.zeros_like(value) for name, value in weights.items()}
        self.square = {name: np.zeros_like(value) for name, value in weights.items()}

    def learn(self, ids: np.ndarray, first: np.ndarray) -> None:
        matrix, _, _ = in_lanes(ids, first)
        state = np.zeros((matrix.shape[1], HIDDEN), np.float32)
        for inputs, targets in windows(matrix, WINDOW):
            cells = Cells(self.weights, inputs, state)
            state = cells.state
            _, grads = output(self.weights, cells.after.reshape(-1, HIDDEN), targets.ravel(), learn=True)
            grads |= cells.gradients(self.weights, grads.pop("state").reshape(cells.after.shape))
            self._update(grads, int((targets >= 0).sum()))
        self.tokens += len(ids)

    def _update(self, grads: Weights, tokens: int) -> None:
        self.step += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / tokens
        scale = np.float32(min(1.0, 1.0 / (size + 1e-9)) / tokens)
        correct = np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for name, grad in grads.items():
            grad = grad * scale
            mean, square = self.mean[name], self.square[name]
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            self.weights[name] -= np.float32(self.rate * correct) * mean / (np.sqrt(square) + 1e-8)
