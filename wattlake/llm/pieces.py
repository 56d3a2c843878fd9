"""SentencePiece encoding and decoding by suffix-array matching, for byte-pair piece models."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.llm.common import Shared, lots

SPACE = "▁"
#: Characters of distinct chunks that one suffix array indexes, and chunks of each of two generations whose pieces are kept at hand.
INDEXED, KEPT = 120_000, 90_000
#: Slots (a power of two) of the table of piece pairs whose adjacency is known.
SLOTS = 1 << 21
#: Characters of the texts that are encoded together.
AT_ONCE = 500_000
#: Characters of longer pieces that are told apart where texts are cut; others share a class.
CLASSES = 8192
_END = 0x110000
#: A text that a model which normalises encodes as another.
_PROBE = "ﬁ Å ２  a\tb\nc  "


class Vocabulary:
    """Pieces, ranks (lower merges first) and byte pieces of a model; read with :func:`read_model`."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces, self.kinds = pieces, kinds
        self.unknown = len(pieces)  # a character that no piece has: it becomes byte pieces
        self.rank = {p: -s for p, s, k in zip(pieces, scores, kinds, strict=True) if k == "normal"}
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "normal"}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "byte"}
        self.spelled = [p.replace(SPACE, " ").encode() if k == "normal" else bytes([int(p[3:5], 16)]) if k == "byte" else b"" for p, k in zip(pieces, kinds, strict=True)]
        self.traces: dict[int, tuple[list[float], list[str], list[str]] | None] = {}

    def merge(self, text: str) -> list[str]:
        """The byte-pair merges themselves, for short strings: best rank first, the leftmost of equals."""
        return self._merged(text)[-1]

    def _merged(self, text: str) -> tuple[list[float], list[str], list[str], list[str]]:
        """Ranks of the merges in turn, the first and the last part before and after each, and the parts at the end."""
        parts = list(text)
        ranks, firsts, lasts = [], parts[:1], parts[-1:]
        while True:
            best = min(((r, i) for i in range(len(parts) - 1) if (r := self.rank.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return ranks, firsts, lasts, parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            ranks.append(best[0])
            firsts.append(parts[0])
            lasts.append(parts[-1])

    def trace(self, piece: int) -> tuple[list[float], list[str], list[str]] | None:
        """How the characters of a piece merge into it; None if they don't."""
        if piece not in self.traces:
            ranks, firsts, lasts, parts = self._merged(self.pieces[piece])
            self.traces[piece] = (ranks, firsts, lasts) if len(parts) == 1 else None
        return self.traces[piece]

    def adjacent(self, before: int, after: int) -> bool:
        """Whether merging the text of two pieces gives just these two; before = -1: the text begins.

        Merges in each go on as if it stood alone, in order of rank, until one across is next.
        """
        right = self.trace(after)
        left = self.trace(before) if before >= 0 else ([], [], [""])
        if left is None or right is None:
            return False
        i = j = 0
        while before >= 0:
            mine = left[0][i] if i < len(left[0]) else math.inf
            other = right[0][j] if j < len(right[0]) else math.inf
            across = self.rank.get(left[2][i] + right[1][j], math.inf)
            if across < mine and across <= other:
                return False
            if mine == other == math.inf:
                break
            i, j = (i + 1, j) if mine <= other else (i, j + 1)
        return True


def read_model(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file (the driver reads it; it has a fixed size).

    Only byte-pair models that leave texts as they are: one that normalises is refused.
    """
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(p.get_piece_size())
    kinds = ["byte" if p.is_byte(i) else "normal" if not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)) else "other" for i in every]
    vocabulary = Vocabulary([p.id_to_piece(i) for i in every], [p.get_score(i) for i in every], kinds)
    if Encoder(vocabulary).encode([_PROBE])[0].tolist() != p.encode(_PROBE):
        raise ValueError(f"{path}: not a byte-pair model with byte pieces that leaves texts as they are")
    return vocabulary


class Spelling:
    """Strings of bytes by number, joined for many numbers at once: each is held as words of eight bytes."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], np.int64)
        self.count = -(-self.size // 8)
        self.first = np.cumsum(self.count) - self.count
        self.word = np.frombuffer(b"".join(x.ljust(8 * n, b"\0") for x, n in zip(strings, self.count.tolist(), strict=True)), np.uint64)
        self.used = np.frombuffer(b"".join((b"\1" * len(x)).ljust(8 * n, b"\0") for x, n in zip(strings, self.count.tolist(), strict=True)), np.uint64)

    def join(self, numbers: np.ndarray, ends: np.ndarray) -> tuple[memoryview, list[int]]:
        """The strings of *numbers* one after another, and the byte after each of the runs of numbers that end at *ends*."""
        count = self.count[numbers]
        row = np.repeat(self.first[numbers] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        flat = self.word[row].view(np.uint8)[self.used[row].view(bool)]
        after = np.concatenate(([0], np.cumsum(self.size[numbers])))
        return memoryview(flat), after[ends].tolist()


class _Known(dict):
    """Ids of chunks, four bytes each.  A chunk that isn't there is taken from the generation before, else noted as new."""

    before: dict[str, bytes]
    new: dict[str, None]

    def __missing__(self, chunk: str) -> bytes | None:
        got = self.before.get(chunk)
        if got is None:
            self.new[chunk] = None
        else:
            self[chunk] = got
        return got


class Encoder:
    """Encodes batches of texts; keeps what it has learned of chunks and pairs, in tables of fixed size."""

    def __init__(self, vocabulary: Vocabulary, indexed: int = INDEXED, kept: int = KEPT):
        self.v, self.indexed, self.kept = vocabulary, indexed, kept
        self._turn({})
        items = sorted(self.v.ids.items())
        self.piece_id = np.array([i for _, i in items])
        self.size = np.array([len(p) for p, _ in items])
        self.width = int(self.size.max(initial=1))
        # characters of pieces in order, from 1 on; several go into one number, as long as it has bits
        letters = sorted({c for p, _ in items for c in p})
        self.letter = np.zeros(_END + 1, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.bits = (len(letters) + 1).bit_length()
        self.packed = max(1, 62 // self.bits)
        words = 1
        while words * self.packed < self.width:
            words *= 2
        code = np.zeros((len(items), words * self.packed), np.int64)
        for row, (p, _) in zip(code, items, strict=True):
            row[: len(p)] = self.letter[[ord(c) for c in p]]
        most = np.where(np.arange(code.shape[1]) < self.size[:, None], code, (1 << self.bits) - 1)
        # each piece's bounds, word by word: what follows it is the least, or the most
        self.least, self.most = (np.stack([self._pack(x[:, w * self.packed : (w + 1) * self.packed].T) for w in range(words)]) for x in (code, most))
        # no piece has both of two neighbours from classes that stand in no pair: texts are cut there
        inner = sorted({c for p, _ in items if len(p) > 1 for c in p})
        self.class_ = np.zeros(_END + 1, np.uint16)
        self.class_[[ord(c) for c in inner]] = np.minimum(np.arange(1, len(inner) + 1), CLASSES)
        self.joined = np.zeros((int(self.class_.max()) + 1,) * 2, bool)
        pairs = np.array(sorted({(ord(a), ord(b)) for p, _ in items for a, b in zip(p, p[1:], strict=False)}), np.int64).reshape(-1, 2)
        self.joined[self.class_[pairs[:, 0]], self.class_[pairs[:, 1]]] = True
        self.pair_key, self.pair_fits = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)
        self.decimal, self.spelled = Spelling([b"%d " % i for i in range(len(self.v.pieces))]), Spelling(self.v.spelled)

    def _turn(self, before: dict[str, bytes]) -> None:
        self.known = _Known()
        self.known.before, self.known.new = before, {}

    # pairs of pieces -----------------------------------------------------------------
    def _fits(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether merging the text of two neighbours gives just these two; before = -1: the chunk begins."""
        key = (before + 1) * (self.v.unknown + 1) + after
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - SLOTS.bit_length())).astype(np.int64)
        new = self.pair_key[slot] != key
        out = self.pair_fits[slot]
        if new.any():
            keys, back = np.unique(key[new], return_inverse=True)
            fits = np.array([self._pair(k // (self.v.unknown + 1) - 1, k % (self.v.unknown + 1)) for k in keys.tolist()])
            out[new] = fits[back]
            self.pair_key[slot[new]] = key[new]
            self.pair_fits[slot[new]] = out[new]
        return out

    def _pair(self, before: int, after: int) -> bool:
        return self.v.unknown in (before, after) or self.v.adjacent(before, after)

    # matching ------------------------------------------------------------------------
    def _pack(self, letters) -> np.ndarray:
        """Rows of letters as one number each, the first the highest."""
        out = np.zeros(letters[0].shape, np.int64)
        for x in letters:
            out = (out << self.bits) | x
        return out

    def _suffixes(self, letter: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Suffix array by as many characters as the longest piece has (prefix doubling, from packed characters on), and the sorted keys of each round."""
        padded = np.concatenate((letter, np.zeros(self.packed, letter.dtype)))
        key = self._pack([padded[k : k + len(letter)] for k in range(self.packed)])
        have, rounds = self.packed, []
        while have < self.width:
            distinct, rank = np.unique(key, return_inverse=True)
            rounds.append(distinct)
            after = np.zeros(len(rank), np.int64)
            after[:-have] = rank[have:] + 1
            key = rank * (len(distinct) + 1) + after
            have *= 2
        order = np.argsort(key, kind="stable")
        return order, [*rounds, key[order]]

    def _ranges(self, rounds: list[np.ndarray], level: int, word: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the pieces *who*, from their *word*-th packed number on, the range of the keys of a round that begin with them, by binary search."""
        keys = rounds[level]
        if not level:
            return np.searchsorted(keys, self.least[word, who], "left"), np.searchsorted(keys, self.most[word, who], "right")
        half, step = 1 << (level - 1), len(rounds[level - 1]) + 1
        low, high = self._ranges(rounds, level - 1, word, who)
        long = np.flatnonzero((self.size[who] > (word + half) * self.packed) & (low < high))
        then = self._ranges(rounds, level - 1, word + half, who[long]) if len(long) else (0, 0)
        first = low[long] * step + 1
        low, high = low * step, high * step
        low[long], high[long] = first + then[0], first + then[1]
        return np.searchsorted(keys, low, "left"), np.searchsorted(keys, high, "left")

    def _edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first position, position after, piece) of every occurrence of every piece, and of characters that no piece has."""
        suffixes, rounds = self._suffixes(self.letter[text])
        low, high = self._ranges(rounds, len(rounds) - 1, 0, np.arange(len(self.size)))
        count = high - low
        owner = np.repeat(np.arange(len(count)), count)
        rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + low[owner]
        begin = suffixes[rows]
        single = np.zeros(len(text) + 1, bool)
        single[begin[self.size[owner] == 1]] = True
        lone = np.flatnonzero(~single[:-1] & (text != _END))
        return np.concatenate((begin, lone)), np.concatenate((begin + self.size[owner], lone + 1)), np.concatenate((self.piece_id[owner], np.full(len(lone), self.v.unknown)))

    def _encode_chunks(self, chunks: list[str]) -> None:
        """Adds the pieces of distinct *chunks* to ``known``.

        Edges are sorted by the position they end at, then relaxed in that order: of the edges
        that end at a position just one follows on from the pieces before it (merging is local:
        a cut holds for a whole text if it holds for the two pieces at it).
        """
        text = np.frombuffer("".join(c + "\0" for c in chunks).encode("utf-32-le"), dtype=np.uint32).copy()
        size = np.array([len(c) for c in chunks])
        start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
        text[start + size] = _END
        begin, end, piece = self._edges(text)
        chunk_start = np.repeat(start, size + 1)
        depth = end - chunk_start[begin]
        order = np.argsort(depth, kind="stable")
        begin, end, piece, depth = begin[order], end[order], piece[order], depth[order]
        last, came = np.full(len(text) + 1, -2, np.int64), np.zeros(len(text) + 1, np.int64)
        last[start] = -1
        bounds = np.searchsorted(depth, np.arange(1, int(size.max()) + 2))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            fits = self._fits(last[begin[a:b]], piece[a:b])
            last[end[a:b][fits]] = piece[a:b][fits]
            came[end[a:b][fits]] = begin[a:b][fits]
        # all chunks are walked back from their ends side by side
        at, owner, order, found = start + size, np.arange(len(chunks)), [], []
        while len(at):
            order.append(owner)
            found.append(np.stack([last[at], came[at]]))
            on = came[at] > start[owner]
            at, owner = came[at][on], owner[on]
        owner, step = np.concatenate(order), np.repeat(np.arange(len(order)), [len(o) for o in order])
        ids, place = np.concatenate(found, axis=1)
        sort = np.lexsort((-step, owner))
        owner, ids, place = owner[sort], ids[sort], place[sort]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(chunks)))))
        packed = ids.astype(np.int32).tobytes()
        known, ends = self.known, (bounds * 4).tolist()
        for i, c in enumerate(chunks):
            known[c] = packed[ends[i] : ends[i + 1]]
        for i in np.unique(owner[ids == self.v.unknown]):
            c, part = chunks[i], slice(bounds[i], bounds[i + 1])
            known[c] = np.array([x for t, p in zip(ids[part], place[part], strict=True) for x in ([t] if t != self.v.unknown else [self.v.bytes[b] for b in c[p - start[i]].encode()])], np.int32).tobytes()

    def encode_lot(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all *texts* one after another, and where those of each end (after a 0).

        The texts are cut into chunks wherever no piece goes across; only chunks that aren't at
        hand are indexed.
        """
        if len(self.known) > self.kept:  # what was used since the last time stays a while
            self._turn(dict(self.known))
        known = self.known
        whole = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        text, ends = "".join(whole), np.cumsum([len(w) for w in whole])
        class_ = self.class_[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        cut = np.ones(len(text) + 1, bool)
        cut[1:-1] = ~self.joined[class_[:-1], class_[1:]]
        cut[ends] = True
        bounds = np.flatnonzero(cut)
        at = bounds.tolist()
        ids = list(map(known.__getitem__, map(text.__getitem__, map(slice, at[:-1], at[1:]))))
        if known.new:
            some, size = [], 0
            for c in known.new:
                some.append(c)
                size += len(c) + 1
                if size >= self.indexed:
                    self._encode_chunks(some)
                    some, size = [], 0
            if some:
                self._encode_chunks(some)
            known.new = {}
            for i in [i for i, x in enumerate(ids) if x is None]:
                ids[i] = known[text[at[i] : at[i + 1]]]
        after = np.concatenate(([0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // 4))
        return np.frombuffer(b"".join(ids), np.int32), np.concatenate(([0], after[np.searchsorted(bounds, ends)]))

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text: a space goes before it, as the model has it; null stays null, empty has none."""
        ids, ends = self.encode_lot(texts)
        return [None if t is None else ids[a:b] for t, a, b in zip(texts, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decode_lot(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The text of each run of ids: pieces joined, byte pieces as UTF-8 (bad bytes as U+FFFD), the first space dropped."""
        flat, at = self.spelled.join(ids, ends)
        return [str(flat[a:b], "utf-8", "replace").removeprefix(" ") for a, b in zip(at[:-1], at[1:], strict=True)]

    def digests(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """SHA-256 of each run of ids in decimal, space-joined."""
        flat, at = self.decimal.join(ids, ends)
        return [hashlib.sha256(flat[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]


def decode(ids: list[int] | np.ndarray | None, vocabulary: Vocabulary) -> str | None:
    """The text of *ids*: pieces joined, byte pieces as UTF-8 (bad bytes as U+FFFD), the first space dropped; null ids: null."""
    if ids is None:
        return None
    return b"".join([vocabulary.spelled[int(i)] for i in ids]).decode("utf-8", "replace").removeprefix(" ")


def with_ids(documents: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds the piece ids of every whole text (null text: null ids; empty text: no ids); replaces a column of that name.

    Ids go back to Spark lot by lot, so neither side holds those of a whole batch.
    """
    shared = Shared(documents.sparkSession, vocabulary)
    rows = documents.drop(ids_col)
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.get(Encoder)
        for batch in batches:
            done = 0
            for lot in lots(batch.column(at).to_pylist(), AT_ONCE):
                values, ends = encoder.encode_lot(lot)
                # a null in the offsets makes the list that begins there null
                offsets = pa.array([None if t is None else e for t, e in zip(lot, ends.tolist(), strict=False)] + ends[-1:].tolist(), pa.int32())
                part = batch.slice(done, len(lot))
                done += len(lot)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))], names=[*part.schema.names, ids_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def with_text(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of piece ids (null ids: null)."""
    shared = Shared(encoded.sparkSession, vocabulary)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spelled = shared.get(lambda v: Spelling(v.spelled))
        for batch in batches:
            sizes = [0 if ids is None else len(ids) for ids in batch]
            flat, at = spelled.join(np.concatenate([np.zeros(0, np.int64), *[ids for ids in batch if ids is not None]]), np.concatenate(([0], np.cumsum(sizes))))
            yield pd.Series([None if ids is None else str(flat[a:b], "utf-8", "replace").removeprefix(" ") for ids, a, b in zip(batch, at[:-1], at[1:], strict=True)], index=batch.index, dtype=object)

    return encoded.withColumn(text_col, run(F.col(ids_col)))


def round_trips(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, round_trip): every whole text is encoded and its ids decoded again.

    The digest is of the ids in decimal, space-joined; a round trip gives the text back (a
    U+2581 in it as a space, as models have it).  Null texts have null counts and digests.
    Batches are worked through and forgotten, so a worker holds one batch and its tables.
    """
    shared = Shared(documents.sparkSession, vocabulary)

    def wide(v: Vocabulary) -> Encoder:
        return Encoder(v, kept=2 * KEPT)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = shared.get(wide)
        for batch in batches:
            count, digest, same = [], [], []
            for lot in lots(batch["text"].tolist(), AT_ONCE):
                ids, ends = encoder.encode_lot(lot)
                for text, n, sha, back in zip(lot, np.diff(ends).tolist(), encoder.digests(ids, ends), encoder.decode_lot(ids, ends), strict=True):
                    count.append(None if text is None else n)
                    digest.append(None if text is None else sha)
                    same.append(text is None or back == text.replace(SPACE, " "))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": pd.array(count, dtype="Int64"), "ids_sha256": digest, "round_trip": same})

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean")
