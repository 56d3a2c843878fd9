"""Quality classifier: a byte-level convolutional network, fitted and run in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import Shared, labelled_sample

#: Most labelled rows of each class that the network is fitted on, and most characters of them together; whole texts.
PER_CLASS, MOST_CHARS = 300, 2_000_000
#: Bytes of a chunk, of a filter, from one window to the next; learned numbers a byte, filters.
CHUNK, WIDTH, STRIDE, EMBED, FILTERS = 1024, 8, 2, 5, 16
#: The repeat channel: a byte is marked if the six bytes up to it also stood this many bytes before, or fewer.
REACH, GRAM = 32, 6
EPOCHS, BATCH, STEP = 14, 64, 0.01
LIMIT = 0.5


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: float


def _encoded(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _repeats(data: np.ndarray) -> np.ndarray:
    """1 where the last GRAM bytes are the same as those at most REACH bytes before."""
    out = np.zeros(len(data), np.uint8)
    if len(data) <= GRAM:
        return out
    gram = np.zeros(len(data) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        gram = (gram << np.uint64(8)) | data[i : len(data) - GRAM + 1 + i]
    for lag in range(1, min(REACH, len(gram) - 1) + 1):
        out[GRAM - 1 + lag :] |= gram[lag:] == gram[:-lag]
    return out


def _chunks(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of CHUNK bytes, the same of the repeat channel, and each document's first chunk.

    Filters stand at every STRIDE-th byte; chunks overlap by a filter's width less STRIDE, so that every
    window of every document is in one; the last is filled up with zero bytes, and so is an empty document.
    """
    step = CHUNK - WIDTH + STRIDE
    n = np.array([max(1, -(-(len(d) - WIDTH + STRIDE) // step)) for d in documents])
    first = np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else np.zeros(0, int)
    data, marks = np.zeros((int(n.sum()), CHUNK), np.uint8), np.zeros((int(n.sum()), CHUNK), np.uint8)
    for d, at, count in zip(documents, first, n, strict=True):
        room = step * (count - 1) + CHUNK
        for source, into in ((d, data), (_repeats(d), marks)):
            padded = np.zeros(room, np.uint8)
            padded[: len(source)] = source
            into[at : at + count] = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]
    return data, marks, first


def _windows(data: np.ndarray, marks: np.ndarray, net: Network) -> np.ndarray:
    """(chunks x windows, WIDTH x channels): what the filters see."""
    x = np.concatenate((net.embed[data], marks[..., None].astype(np.float32)), axis=2)
    flat = np.lib.stride_tricks.sliding_window_view(x.reshape(len(data), -1), WIDTH * x.shape[2], axis=1)
    return flat[:, :: STRIDE * x.shape[2]].reshape(-1, WIDTH * x.shape[2])


def _pooled(data: np.ndarray, marks: np.ndarray, net: Network, places: bool = False, at_once: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Greatest response of each filter in each chunk, and (if *places*) where."""
    top, where = np.empty((len(data), len(net.bias)), np.float32), np.empty((len(data), len(net.bias)), np.int64)
    for i in range(0, len(data), at_once):
        part = data[i : i + at_once]
        response = (_windows(part, marks[i : i + at_once], net) @ net.filters).reshape(len(part), -1, len(net.bias))
        top[i : i + at_once] = response.max(1)
        if places:
            where[i : i + at_once] = response.argmax(1) * STRIDE
    return np.maximum(top + net.bias, 0), where


def fit_network(samples: list[tuple[str, int]], seed: int = 11) -> Network:
    """A network fitted to (text, 0 or 1): Adam on the logistic loss, classes weighed alike; deterministic."""
    rng = np.random.default_rng(seed)
    channels = EMBED + 1
    net = Network(
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, (2 / (WIDTH * channels)) ** 0.5, (WIDTH * channels, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0,
    )
    y = np.array([label for _, label in samples], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        net.out[:] = 0
        net.base = 0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1)
        return net
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    documents = [_encoded(t) for t, _ in samples]
    names = ("embed", "filters", "bias", "out")
    first_m, second_m = {n: 0.0 for n in (*names, "base")}, {n: 0.0 for n in (*names, "base")}
    t = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for lot in np.array_split(order, max(1, len(y) // BATCH)):
            data, marks, first = _chunks([documents[i] for i in lot])
            top, where = _pooled(data, marks, net, places=True)
            most = np.maximum.reduceat(top, first, axis=0)
            off = (1 / (1 + np.exp(-(most @ net.out + net.base))) - y[lot]) * weight[lot] / len(lot)
            grad = {n: np.zeros_like(getattr(net, n)) for n in names} | {"out": most.T @ off, "base": off.sum()}
            owner = np.repeat(np.arange(len(lot)), np.diff(np.concatenate((first, [len(data)]))))
            back = off[:, None] * net.out[None, :]
            # only the window with the greatest response gets a gradient
            chunk, filt = np.nonzero((top == most[owner]) & (top > 0))
            _, keep = np.unique(owner[chunk] * FILTERS + filt, return_index=True)
            chunk, filt = chunk[keep], filt[keep]
            g = back[owner[chunk], filt]
            place = where[chunk, filt][:, None] + np.arange(WIDTH)
            seen = data[chunk[:, None], place]
            x = np.concatenate((net.embed[seen], marks[chunk[:, None], place][..., None].astype(np.float32)), axis=2).reshape(len(g), -1)
            np.add.at(grad["filters"].T, filt, x * g[:, None])
            np.add.at(grad["bias"], filt, g)
            through = (net.filters.T[filt] * g[:, None]).reshape(len(g), WIDTH, channels)[..., :EMBED]
            np.add.at(grad["embed"], seen.ravel(), through.reshape(-1, EMBED))
            t += 1
            for n, d in grad.items():
                first_m[n] = 0.9 * first_m[n] + 0.1 * d
                second_m[n] = 0.999 * second_m[n] + 0.001 * d**2
                move = STEP * (first_m[n] / (1 - 0.9**t)) / (np.sqrt(second_m[n] / (1 - 0.999**t)) + 1e-8)
                setattr(net, n, (getattr(net, n) - move) if n == "base" else (getattr(net, n) - move).astype(np.float32))
    return net


def scores(texts: list[str | None], net: Network) -> np.ndarray:
    """One probability for each text: its chunks' filter responses, max-pooled over the whole text and combined."""
    out = np.empty(len(texts))
    at = 0
    while at < len(texts):
        lot, size = [], 0
        while at + len(lot) < len(texts) and (not lot or size < 262_144):
            lot.append(_encoded(texts[at + len(lot)]))
            size += len(lot[-1])
        data, marks, first = _chunks(lot)
        most = np.maximum.reduceat(_pooled(data, marks, net)[0], first, axis=0)
        out[at : at + len(lot)] = 1 / (1 + np.exp(-np.clip(most @ net.out + net.base, -30, 30)))
        at += len(lot)
    return out


def learn(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS) -> Network:
    """Fit on at most *per_class* whole texts of each class of ``labels.quality`` outside the held-out fold."""
    return fit_network(labelled_sample(documents, labels, "quality", per_class, most_chars))


def scorer(spark: SparkSession, net: Network):
    """A column function: text to its score."""
    shared = Shared(spark, net)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.get()
        for batch in batches:
            yield pd.Series(scores(batch.tolist(), model), index=batch.index)

    return run


def score(documents: DataFrame, net: Network, text_col: str = "text", out_col: str = "_score") -> DataFrame:
    """*documents* with *out_col* (0 to 1, higher: better).  Null texts score as empty ones do; without labels all score 0.5."""
    return documents.withColumn(out_col, scorer(documents.sparkSession, net)(F.col(text_col)))


def accept(documents: DataFrame, labels: DataFrame, known: DataFrame, least: float = LIMIT) -> DataFrame:
    """The rows of *documents* that score *least* or more, all columns as they are; the network is fitted on *known* documents with *labels*."""
    return documents.filter(scorer(documents.sparkSession, learn(known, labels))(F.col("text")) >= least)
