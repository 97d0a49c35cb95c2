"""The forward passes of both models against plain loops, one number at a time."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from kindred.llm import cnn, gru
from kindred.llm.texts import text_bytes


def plain_probability(weights, data: bytes) -> float:
    chunks, begin = [], 0
    while True:
        chunks.append(data[begin : begin + cnn.CHUNK])
        if begin + cnn.CHUNK >= len(data):
            break
        begin += cnn.STRIDE
    total = [0.0] * cnn.HIDDEN
    for chunk in chunks:
        numbers = list(chunk) + [cnn.NONE] * (cnn.CHUNK - len(chunk))
        best = [-math.inf] * cnn.FILTERS
        for at in range(0, cnn.CHUNK - cnn.WIDTH + 1, cnn.HOP):
            window = [float(x) for n in numbers[at : at + cnn.WIDTH] for x in weights["bytes"][n]]
            seen = np.array(window) @ weights["filters"].astype(float)
            best = [max(old, float(new)) for old, new in zip(best, seen)]
        inputs = [max(value + float(level), 0.0) for value, level in zip(best, weights["levels"])] + [len(chunk) / cnn.CHUNK]
        for unit in range(cnn.HIDDEN):
            mixed = sum(x * float(weights["mix"][i][unit]) for i, x in enumerate(inputs)) + float(weights["mix_levels"][unit])
            total[unit] += max(mixed, 0.0)
    last = sum(t / len(chunks) * float(w) for t, w in zip(total, weights["last"])) + float(weights["last_level"][0])
    return 1 / (1 + math.exp(-last))


def test_probability_of_texts_of_many_chunks():
    draw = np.random.default_rng(4)
    weights = {name: value + draw.normal(0, 0.2, value.shape).astype(np.float32) for name, value in cnn.initial().items()}
    texts = ["", "a", "short text, one chunk", "é漢 " * 70, "x" * cnn.CHUNK, "y" * (cnn.CHUNK + 1), "".join(map(chr, draw.integers(32, 1000, 1_500)))]
    found = cnn.probabilities(weights, *text_bytes(pa.array(texts + [None])))
    want = [plain_probability(weights, text.encode()) for text in texts + [""]]
    assert np.allclose(found, want, rtol=1e-4) and len({round(x, 6) for x in want}) == len(texts)


def plain_score(weights, ids: list[int]) -> float:
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    h = gru.HIDDEN
    state, before, total = [0.0] * h, gru.END, 0.0
    for token in ids:
        if before == gru.END:
            state = [0.0] * h
        mixed = [sum(state[i] * float(weights["u"][i][j]) for i in range(h)) for j in range(3 * h)]
        fed = [float(x) for x in weights["x"][before]]
        update = [sigmoid(fed[j] + mixed[j]) for j in range(h)]
        reset = [sigmoid(fed[h + j] + mixed[h + j]) for j in range(h)]
        new = [math.tanh(fed[2 * h + j] + reset[j] * mixed[2 * h + j]) for j in range(h)]
        state = [new[j] + update[j] * (state[j] - new[j]) for j in range(h)]

        def log_share(columns, levels, which):
            values = [sum(state[i] * float(columns[i][k]) for i in range(h)) + float(levels[k]) for k in range(len(levels))]
            return values[which] - math.log(sum(map(math.exp, values)))

        group = token // gru.CLASS_SIZE
        total += log_share(weights["wc"], weights["bc"], group)
        if token != gru.TAIL:
            total += log_share(weights["wo"][group], weights["bo"][group], token % gru.CLASS_SIZE)
        before = token
    return total


@pytest.mark.parametrize("steps", [2 * gru.WINDOW, 7])
def test_likelihood_of_texts_of_many_windows(steps):
    draw = np.random.default_rng(6)
    weights = {name: value + draw.normal(0, 0.3, value.shape).astype(np.float32) for name, value in gru.initial(np.arange(gru.TAIL + 1)).items()}
    sizes = (0, 1, 150, 40, 70)
    texts = [[*(int(t) for t in draw.choice([*range(50), gru.TAIL, 700], n)), gru.END] for n in sizes]
    first = np.cumsum([0, *map(len, texts)])
    found = gru.score(weights, np.concatenate(texts).astype(np.int32), first, steps=steps)
    assert np.allclose(found, [plain_score(weights, text) for text in texts], rtol=1e-4)
