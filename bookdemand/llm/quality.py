"""Quality classifier: a byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes slide over the whole text, their responses are max-pooled
over overlapping chunks, and the chunks' features, averaged and at their largest,
give one probability.  A filter is a table of weights by position and byte value, so a
response is a sum of table rows; in training only the byte windows that won a chunk's
maximum get a gradient.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import Shared, training_sample

WIDTH = 6
STEP = 32  # positions pooled first
CHUNK_STEPS = 8  # a chunk is 8 steps (256 positions); chunks overlap by one step
PART_BYTES = 1 << 18


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 256 x F
    bias: np.ndarray  # F
    mean_weight: np.ndarray  # F
    max_weight: np.ndarray  # F
    offset: float

    @staticmethod
    def new(count: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        return Network(rng.normal(0, 0.3, (WIDTH, 256, count)).astype(np.float32), np.zeros(count, np.float32),
                       rng.normal(0, 0.3, count).astype(np.float32), np.zeros(count, np.float32), 0.0)

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.mean_weight, self.max_weight]


def padded(text: str | None) -> np.ndarray:
    """The text's bytes, with blanks so that every byte is the end of a window."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return np.frombuffer(b" " * (WIDTH - 1) + raw + b" " * (not raw), np.uint8)


def steps_of(net: Network, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter in each step, and where it was."""
    n = len(data) - WIDTH + 1
    response = net.filters[0][data[:n]]
    for k in range(1, WIDTH):
        response += net.filters[k][data[k:k + n]]
    steps = -(-n // STEP)
    if steps * STEP > n:
        response = np.concatenate([response, np.full((steps * STEP - n, response.shape[1]), -np.inf, np.float32)])
    response = response.reshape(steps, STEP, -1)
    best = response.argmax(axis=1)
    top = np.take_along_axis(response, best[:, None, :], 1)[:, 0]
    return top, best + STEP * np.arange(steps)[:, None]


def chunks_of(top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Max over chunks of CHUNK_STEPS steps, each sharing a step with the next; the step that won."""
    starts = np.arange(0, max(1, len(top) - 1), CHUNK_STEPS - 1)
    rows = np.minimum(starts[:, None] + np.arange(CHUNK_STEPS), len(top) - 1)
    windows = top[rows]
    won = windows.argmax(axis=1)
    return np.take_along_axis(windows, won[:, None, :], 1)[:, 0], np.take_along_axis(rows, won, 1)


def pair_tables(net: Network) -> list[np.ndarray]:
    """The filters as tables over two neighbouring bytes: half as many look-ups."""
    return [(net.filters[k][:, None, :] + net.filters[k + 1][None, :, :]).reshape(1 << 16, -1) for k in range(0, WIDTH, 2)]


def tops_of(tables: list[np.ndarray], data: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each step, for scoring."""
    n = len(data) - WIDTH + 1
    pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
    steps = -(-n // STEP)
    response = np.empty((steps * STEP, tables[0].shape[1]), np.float32)
    response[n:] = -np.inf
    np.take(tables[0], pairs[:n], axis=0, out=response[:n], mode="clip")
    for k, one in enumerate(tables[1:], 1):
        response[:n] += one[pairs[2 * k:2 * k + n]]
    wide = STEP
    while wide > 1:
        wide //= 2
        response = response.reshape(steps, 2, -1)
        response = np.maximum(response[:, 0], response[:, 1])
    return response


def features(net: Network, data: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
    """Chunk features of a whole text; long texts go through in parts whose steps are joined."""
    tables = tables or pair_tables(net)
    part = PART_BYTES // STEP * STEP
    tops = [tops_of(tables, data[start:start + part + WIDTH - 1]) for start in range(0, len(data) - WIDTH + 1, part)]
    top, _ = chunks_of(np.concatenate(tops))
    return np.maximum(top + net.bias, 0)


def probability(net: Network, data: np.ndarray, tables: list[np.ndarray] | None = None) -> float:
    h = features(net, data, tables)
    z = float(h.mean(axis=0) @ net.mean_weight + h.max(axis=0) @ net.max_weight + net.offset)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[str, int]], filters: int = 16, epochs: int = 5, rate: float = 0.02, seed: int = 11) -> Network:
    """Adam on the log loss, one text at a time in small batches; no rows: an even coin."""
    net = Network.new(filters, seed)
    if not rows:
        return net
    texts = [padded(t) for t, _ in rows]
    target = np.array([y for _, y in rows], np.float32)
    share = float(np.clip(target.mean(), 0.02, 0.98))
    net.offset = float(np.log(share / (1 - share)))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in net.parameters()]
    offset_moment, rng, turn = [0.0, 0.0], np.random.default_rng(seed), 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), 32):
            grads, d_offset, batch = [np.zeros_like(p) for p in net.parameters()], 0.0, order[start:start + 32]
            for k in batch:
                data = texts[k]
                top, place = steps_of(net, data)
                pooled, step = chunks_of(top)
                h = np.maximum(pooled + net.bias, 0)
                peak = h.argmax(axis=0)
                z = h.mean(axis=0) @ net.mean_weight + h[peak, np.arange(filters)] @ net.max_weight + net.offset
                error = float(1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[k])
                grads[2] += error * h.mean(axis=0)
                grads[3] += error * h[peak, np.arange(filters)]
                d_offset += error
                back = np.tile(error * net.mean_weight / len(h), (len(h), 1))
                back[peak, np.arange(filters)] += error * net.max_weight
                back[h <= 0] = 0
                grads[1] += back.sum(axis=0)
                row, column = np.nonzero(back)
                where = place[step[row, column], column]
                for j in range(WIDTH):
                    np.add.at(grads[0][j], (data[where + j], column), back[row, column])
            turn += 1
            speed = rate * (0.5 ** (epoch / 3)) * np.sqrt(1 - 0.999 ** turn) / (1 - 0.9 ** turn)
            for p, g, m in zip(net.parameters(), grads, moments):
                g = g / len(batch) + 1e-5 * p
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                p -= (speed * m[0] / (np.sqrt(m[1]) + 1e-8)).astype(np.float32)
            g = d_offset / len(batch)
            offset_moment = [0.9 * offset_moment[0] + 0.1 * g, 0.999 * offset_moment[1] + 0.001 * g * g]
            net.offset -= speed * offset_moment[0] / (np.sqrt(offset_moment[1]) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", max_rows: int = 3000,
        max_chars: int = 20_000, **settings) -> Network:
    """A network fitted on a bounded sample: at most ``max_rows`` labelled texts of at most
    ``max_chars`` characters, picked by a hash of doc_id among the rows ``allowed`` admits."""
    return train(training_sample(docs, labels, label, allowed, max_rows, max_chars), **settings)


def score(docs: DataFrame, net: Network, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the probability of label 1 for the whole text.

    Null texts count as empty, which get the score of a blank; equal texts get equal
    scores; all columns stay (a column that already has the name is replaced).
    """
    shared = Shared(docs.sparkSession, net)  # WIDTH * 256 * filters floats

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = pair_tables(shared.value)
        for part in texts:
            yield pd.Series([probability(shared.value, padded(t), tables) for t in part], dtype="float64")

    return docs.withColumn(name, run(F.col("text").cast("string")))
