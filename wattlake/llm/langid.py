"""Language ID: a linear-chain conditional random field over the words of a text, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import Shared, class_sample, fold, lots, thinned

#: Most training documents of each language, and most characters of them together; whole texts.
PER_LANGUAGE, MOST_CHARS = 400, 400_000
#: Rows of the hashed weight table.
TABLE = 1 << 16
#: Words of a training sequence, and of a block of forward-backward.
LENGTH, BLOCK = 96, 64
ROUNDS, STEP, DECAY = 40, 0.3, 1e-4
#: Different words whose features a fit looks up at once, which bounds what the driver holds beside the words themselves.
AT_ONCE = 2048
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Field:
    """A fitted field: labels (sorted), feature weights (TABLE x labels), transitions, start."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray


def words(text: str | None) -> list[str]:
    """Runs of letters in lower case; a run of numerals that aren't digits (like ½) is none."""
    return [w for w in _WORD.findall(text.lower()) if w.isalpha() or any(c.isalpha() for c in w)] if text else []


def _features(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for each distinct word, and where each word's begin.

    Features: every 1-, 2- and 3-gram of the word between boundary marks, so that those at the
    marks are its prefixes and suffixes, and the whole word (the lexicon).
    """
    marked = [f"\x02{w}\x03" for w in distinct]
    size = np.array([len(m) for m in marked])
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    left = np.repeat(begin + size, size) - np.arange(len(code))  # characters to the word's end, this one included
    pad = np.concatenate((code, np.zeros(2, np.uint64)))
    mix = np.uint64(0x9E3779B97F4A7C15)
    one = (code + np.uint64(1)) * mix
    two = (one ^ (pad[1:-1] + np.uint64(7))) * mix
    three = (two ^ (pad[2:] + np.uint64(13))) * mix
    place = np.arange(len(code), dtype=np.uint64) - np.repeat(begin, size).astype(np.uint64)
    whole = np.add.reduceat((code * mix) ^ ((place + np.uint64(3)) * np.uint64(0xC2B2AE3D27D4EB4F)) * code, begin) * mix
    hashed = np.stack([one, np.where(left > 1, two, one), np.where(left > 2, three, one)], axis=1).ravel()
    shift = np.uint64(64 - 16)
    rows = np.concatenate((hashed >> shift, whole >> shift)).astype(np.int64)
    owner = np.concatenate((np.repeat(np.arange(len(distinct)), size * 3), np.arange(len(distinct))))
    order = np.argsort(owner, kind="stable")
    return rows[order], np.concatenate(([0], np.cumsum(size * 3 + 1)[:-1]))


def _scores(weights: np.ndarray, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Emission score of each word: the mean of its features' weights, times a constant."""
    count = np.diff(np.concatenate((begin, [len(rows)])))[:, None]
    return 8 * np.add.reduceat(weights[rows], begin, axis=0) / count


def _forward_backward(emit: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (S, T, K) and summed pair marginals (K, K) of S sequences of equal length."""
    s, t, k = emit.shape
    e = emit - emit.max(2, keepdims=True)
    np.exp(e, out=e)
    m = np.exp(moves)
    ahead, back = np.empty((s, t, k)), np.empty((s, t, k))
    ahead[:, 0] = np.exp(start) * e[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        a = ahead[:, i - 1] @ m * e[:, i]
        ahead[:, i] = a / a.sum(1, keepdims=True)
    back[:, -1] = 1
    pairs = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        right = e[:, i + 1] * back[:, i + 1]
        joint = ahead[:, i, :, None] * m * right[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        b = right @ m.T
        back[:, i] = b / b.sum(1, keepdims=True)
    ahead *= back
    ahead /= ahead.sum(2, keepdims=True)
    return ahead, pairs


def fit_field(samples: list[tuple[str, str]], seed: int = 7) -> Field:
    """A field fitted to (text, language) pairs.

    Training sequences are spliced from pieces of 8 to 40 words of different samples, each word
    with its sample's language, so that transitions between languages are learned too.
    Full-batch AdaGrad on the likelihood; deterministic.
    """
    labels = sorted({lang for _, lang in samples})
    if not labels:
        return Field([], np.zeros((TABLE, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    pieces: list[tuple[np.ndarray, int]] = []
    vocabulary: dict[str, int] = {}
    for text, lang in sorted(samples):
        found, at = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words(text)], dtype=np.int32), 0
        while at < len(found):
            n = int(rng.integers(8, 41))
            pieces.append((found[at : at + n], labels.index(lang)))
            at += n
    if not pieces:
        return Field(labels, np.zeros((TABLE, len(labels)), np.float32), np.zeros((len(labels),) * 2), np.zeros(len(labels)))
    rng.shuffle(pieces)
    ids, gold = np.concatenate([p for p, _ in pieces]), np.repeat(np.array([y for _, y in pieces], dtype=np.int32), [len(p) for p, _ in pieces])
    # words are numbered anew in the order in which the shuffled pieces have them
    by_place = np.argsort(np.unique(ids, return_index=True)[1])
    place = np.empty_like(by_place)
    place[by_place] = np.arange(len(by_place))
    ids, distinct = place[ids], list(vocabulary)
    distinct = [distinct[i] for i in by_place]
    del pieces, vocabulary
    t = min(LENGTH, len(ids))
    s = len(ids) // t
    ids, gold = ids[: s * t].reshape(s, t), gold[: s * t].reshape(s, t)
    k = len(labels)
    # lots of words; the rows of the weight table in as few bytes as they need
    parts = []
    for at in range(0, len(distinct), AT_ONCE):
        rows, begin = _features(distinct[at : at + AT_ONCE])
        parts.append((rows.astype(np.int32), begin))
    count = np.concatenate([np.diff(np.concatenate((begin, [len(rows)]))) for rows, begin in parts])
    n_words, rows = len(distinct), np.concatenate([r for r, _ in parts])
    del distinct
    weights, moves, start = np.zeros((TABLE, k)), np.zeros((k, k)), np.zeros(k)
    past = [np.full_like(x, 1e-8) for x in (weights, moves, start)]
    target = np.eye(k)
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    for _ in range(ROUNDS):
        emit = np.concatenate([_scores(weights, r, b) for r, b in parts])
        p, pairs = _forward_backward(emit[ids], moves, start)
        off = np.subtract(target[gold], p, out=p).reshape(-1, k)
        per_word = np.stack([np.bincount(ids.ravel(), off[:, j], n_words) for j in range(k)], axis=1) * 8 / count[:, None]
        # a language at once; sums go in the order of the words
        g = np.stack([np.bincount(rows, np.repeat(per_word[:, j], count), TABLE) for j in range(k)], axis=1)
        for x, grad, old in ((weights, g - DECAY * len(off) * weights, past[0]), (moves, seen - pairs, past[1]), (start, p[:, 0].sum(0), past[2])):
            old += grad**2
            x += STEP * grad / np.sqrt(old)
    return Field(labels, weights.astype(np.float32), moves, start)


def _marginals(emit: np.ndarray, lengths: np.ndarray, field: Field) -> np.ndarray:
    """Exact word marginals of sequences that lie one after the other in *emit*.

    Sequences are cut in blocks of BLOCK words.  All blocks' transfer matrices are built side by
    side, chained along each sequence, and then the blocks' words are run with what enters each
    block from either end; so the numpy calls grow with the longest sequence over BLOCK only.
    """
    k = len(field.labels)
    blocks = -(-lengths // BLOCK)
    n, total = int(blocks.sum()), len(emit)
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    owner = np.repeat(np.arange(len(lengths)), blocks)
    within = np.arange(n) - first[owner]
    offset = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    size = np.minimum(BLOCK, lengths[owner] - within * BLOCK)
    slot = np.repeat(np.arange(n), size), np.arange(total) - np.repeat(offset[owner] + within * BLOCK, size)
    e = np.ones((BLOCK, n, k))
    e[slot[1], slot[0]] = np.exp(emit - emit.max(1, keepdims=True))
    live = np.arange(BLOCK)[:, None] < size[None, :]
    m = np.exp(field.moves - field.moves.max())
    full = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    # no transition leads to the first word of a sequence
    begins = (within == 0)[:, None]
    for i in range(BLOCK):
        on = slice(None) if live[i].all() else np.flatnonzero(live[i])
        moved = full[on] @ m
        if not i:
            moved = np.where(begins[:, :, None], full, moved)
        step = moved * e[i, on][:, None, :]
        full[on] = step / step.sum((1, 2), keepdims=True)
    # what enters each block from the left (before its first transition) and from the right
    enter, leave = np.empty((n, k)), np.empty((n, k))
    enter[first] = np.exp(field.start - field.start.max())
    last = first + blocks - 1
    leave[last] = 1
    by_depth = np.argsort(within, kind="stable")
    bounds = np.searchsorted(within[by_depth], np.arange(int(blocks.max()) + 1))
    for d in range(1, int(blocks.max())):
        at = by_depth[bounds[d] : bounds[d + 1]]
        v = np.einsum("nk,nkj->nj", enter[at - 1], full[at - 1])
        enter[at] = v / np.abs(v).sum(1, keepdims=True)
    for d in range(int(blocks.max()) - 1, 0, -1):
        at = by_depth[bounds[d] : bounds[d + 1]]
        v = np.einsum("nkj,nj->nk", full[at], leave[at])
        leave[at - 1] = v / np.abs(v).sum(1, keepdims=True)
    ahead = np.empty((BLOCK, n, k))
    now = enter
    for i in range(BLOCK):
        now = (now @ m if i else np.where(begins, now, now @ m)) * e[i]
        now = now / np.maximum(now.sum(1, keepdims=True), 1e-300)
        ahead[i] = now
    out = np.empty((total, k))
    back = np.ones((n, k))
    for i in range(BLOCK - 1, -1, -1):
        ends = size - 1 == i
        back = np.where(ends[:, None], leave, back)
        both = ahead[i] * back
        both /= np.maximum(both.sum(1, keepdims=True), 1e-300)
        ahead[i] = both
        back = (back * e[i]) @ m.T
        back = back / np.maximum(back.sum(1, keepdims=True), 1e-300)
    out[:] = ahead[slot[1], slot[0]]
    return out


def label_words(texts: list[list[str]], field: Field) -> list[np.ndarray]:
    """For each text (a list of words) the marginals of its words, a row a word in the order of the labels."""
    lengths = np.array([len(t) for t in texts])
    found: list[np.ndarray] = [np.zeros((0, len(field.labels)))] * len(texts)
    full = np.flatnonzero(lengths)
    if not len(full) or not field.labels:
        return found
    vocabulary: dict[str, int] = {}
    put = vocabulary.setdefault
    ids = np.array([put(w, len(vocabulary)) for t in texts for w in t])
    emit = _scores(field.weights, *_features(list(vocabulary)))[ids]
    p = _marginals(emit, lengths[full], field)
    for i, part in zip(full, np.split(p, np.cumsum(lengths[full])[:-1]), strict=True):
        found[i] = part
    return found


def learn(documents: DataFrame, per_language: int = PER_LANGUAGE, most_chars: int = MOST_CHARS) -> Field:
    """Fit a field on at most *per_language* whole documents of each lang, of *most_chars* characters together.

    Only rows with a lang and a doc_id whose crc32 mod 5 isn't 0 are taken.
    """
    known = documents.filter("text is not null and lang is not null").filter(fold("doc_id", 5) != 0).select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("class"))
    few = thinned(known, known.groupBy("class").agg(F.count("*").alias("n")), per_language)
    return fit_field(class_sample(few, per_language, most_chars))


def labeller(spark: SparkSession, field: Field):
    """A column function: text to struct(lang_pred string, score double)."""
    shared = Shared(spark, field)  # TABLE x languages floats

    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.get()
        for batch in batches:
            names, scores = [], []
            for lot in lots(batch.tolist(), 300_000):
                for p in label_words([words(t) for t in lot], model):
                    names.append(model.labels[int(p.mean(0).argmax())] if p.size else UNKNOWN)
                    scores.append(float(min(1.0, p.mean(0).max())) if p.size else 0.0)
            yield pd.DataFrame({"lang_pred": names, "score": scores}, index=batch.index)

    return label


def predict(documents: DataFrame, field: Field, text_col: str = "text", out_col: str = "_lang") -> DataFrame:
    """*documents* with *out_col* struct(lang_pred string, score double).

    The language is the one with most words, each word counted by its marginals; the score is
    its share of them.  A text that is null or has no letter is ``und`` with score 0, as is
    every text if there was nothing to learn from.
    """
    return documents.withColumn(out_col, labeller(documents.sparkSession, field)(F.col(text_col)))


def accept(documents: DataFrame, least: float = 0.35) -> DataFrame:
    """The rows of *documents* whose text is in a known language, all columns as they are.

    More than *least* of the words must be in it (four languages share alike at 0.25); texts
    without a letter go.  Where no row has a language to learn from, every row goes.
    """
    label = labeller(documents.sparkSession, learn(documents))
    return documents.filter(label(F.col("text"))["score"] > least)
