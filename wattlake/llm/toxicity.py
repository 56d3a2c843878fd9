"""Toxicity: a weighted finite-state grammar over clauses, composed of small transducers."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import Shared, labelled_sample

#: Most labelled rows of each class that weights are learned from, and most characters of them together; whole texts.
PER_CLASS, MOST_CHARS = 2500, 16_000_000
#: An entry of the lexicon needs this log-likelihood ratio and to be so many times commoner in toxic texts; prefixes of so many letters are entries.
EVIDENCE, COMMONER, SHORTEST, LONGEST = 10.0, 4, 3, 14
LIMIT = 0.7
#: Squared weight that counts as one, and the most that one kind of clause counts.
UNIT, MOST = 16.0, 4.0
# Closed-class words of the grammar, in English, German, French and Spanish.
YOU = "you you'll you're your yourself u du dich dir dein deine ihr euch tu toi te ton ta vous votre tú ti usted ustedes vosotros"
OTHERS = "they them she he him her sie ihn ihm ils elles ellos ellas"
INTENTS = "will shall going gonna want wants must should i'll we'll he'll she'll they'll werde werden wird wirst will wollen soll sollte muss vais va allons vont veux dois doit voy va vamos van quiero debo debe deben"
NEGATIONS = "not no never isn't aren't wasn't don't doesn't nicht kein keine nie niemals pas jamais aucun aucune nunca jamás ningún ninguna tampoco"
REPORTS = "said says say called calls wrote writes quoted quote quotes told claimed sagte sagt schrieb nannte zitiert dit disait écrit appelé cité dijo dice escribió llamó citó"
# Forms of verbs of violence, by what they begin with ("-": nothing more), and a German verb in two parts.
THREATS = {
    "kill": "- s ed ing", "murder": "- s ed ing", "hurt": "- s ing", "destroy": "- s ed ing", "beat": "- s en ing", "burn": "- s ed t ing",
    "sho": "ot ots oting t", "stab": "- s bed bing", "strangl": "e es ed ing", "umbring": "e st t en", "umgebracht": "-", "umzubringen": "-",
    "töt": "e est et en ete eten", "getötet": "-", "erschieß": "e t en", "erschlag": "e en", "schlag": "e en", "schläg": "st t", "verprügel": "- e n st t",
    "vernicht": "e est et en", "tue": "r rai ras ra rons ront", "tué": "- e s es", "frappe": "r rai ras ra rons ront", "détrui": "re rai ras ra rons ront t",
    "brûle": "r rai ras ra rons ront", "étrangle": "r rai ra", "mat": "ar aré arás ará aremos arán ando", "golpe": "ar aré ará aremos arán ando",
    "destru": "ir iré irá iremos irán yo ye", "quem": "ar aré ará aremos arán", "apuñal": "ar aré ará arán",
}
BRINGS, APART = "bringe bringst bringt bringen", "um"
#: What a word of violence weighs; an insult has its log odds.
VIOLENCE = 4.0

_TOKEN = re.compile(r"\w+(?:'\w+)?|[.!?;:\n]")
_STOPS = frozenset(".!?;:\n")
SYMBOLS = INSULT, THREAT, SECOND, TARGET, INTENT, NEGATION, REPORT, BRING, UM, OTHER = "insult", "violence", "second", "target", "intent", "negation", "report", "bring", "um", "other"
#: How a matched clause ends up: each has a weight of its own.
KINDS = ("plain", "aimed", "denied", "reported", "threat", "harm")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``arcs`` has (state, symbol) -> (next state, output); what it lacks stays and is passed on."""

    start: str
    arcs: dict[tuple[str, str], tuple[str, str]]

    def step(self, state: str, symbol: str) -> tuple[str, str]:
        return self.arcs.get((state, symbol), (state, symbol))


@dataclass(frozen=True)
class Composed:
    """Transducers in a row: what one puts out goes into the next; the state is that of all."""

    parts: tuple[Transducer, ...]

    @property
    def start(self) -> tuple[str, ...]:
        return tuple(p.start for p in self.parts)

    def step(self, state: tuple[str, ...], symbol: str) -> tuple[tuple[str, ...], str]:
        out = []
        for part, s in zip(self.parts, state, strict=True):
            s, symbol = part.step(s, symbol)
            out.append(s)
        return tuple(out), symbol


def _window(trigger: str, reach: int, changes: dict[str, str]) -> Transducer:
    """For *reach* symbols after *trigger*, symbols in *changes* are replaced."""
    symbols = {*SYMBOLS, *changes}
    arcs = {("0", trigger): (str(reach), trigger)}
    for left in range(1, reach + 1):
        for s in symbols:
            arcs[(str(left), s)] = (str(left - 1), changes.get(s, s))
        arcs[(str(left), trigger)] = (str(reach), trigger)
    return Transducer("0", arcs)


def _after(trigger: str, changes: dict[str, str]) -> Transducer:
    """From *trigger* to the end of the clause, symbols in *changes* are replaced."""
    return Transducer("0", {("0", trigger): ("1", trigger)} | {("1", s): ("1", t) for s, t in changes.items()})


#: Whom a clause is aimed at: violence against a second person is a threat, against others it is harm so far.
AIM = (_after(SECOND, {INSULT: "aimed", THREAT: "threat!", "harm!": "threat!"}), _after(TARGET, {INSULT: "aimed", THREAT: "harm!"}))
#: Read from right to left first: a verb in two parts is one of violence, and an insult or violence before its target is aimed too.
BACKWARD = Composed((Transducer("0", {("0", UM): ("1", OTHER), ("1", UM): ("1", OTHER), ("1", BRING): ("0", THREAT), ("0", BRING): ("0", OTHER)}), *AIM))
#: Then from left to right: a target, an intention and reported speech reach to the end of the clause, negation three words on; harm that is intended is a threat.
GRAMMAR = Composed((
    *AIM,
    _after(INTENT, {"harm!": "threat!"}),
    _window(NEGATION, 3, {INSULT: "denied", "aimed": "denied", "threat!": OTHER, "harm!": OTHER}),
    _after(REPORT, {INSULT: "reported", "aimed": "reported", "threat!": OTHER, "harm!": OTHER}),
    Transducer("0", {("0", INSULT): ("0", "plain"), ("0", "threat!"): ("0", "threat"), ("0", "harm!"): ("0", "harm"), ("0", THREAT): ("0", OTHER)}),
))


@dataclass
class Grammar:
    """Lexicon of insults (prefix -> weight), and the weights of the kinds of clause."""

    insults: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(KINDS) + 1))

    def __post_init__(self):
        self.lengths = sorted({len(p) for p in self.insults})
        self.closed = {w: c for words, c in ((INTENTS, INTENT), (OTHERS, TARGET), (YOU, SECOND), (NEGATIONS, NEGATION), (REPORTS, REPORT), (BRINGS, BRING), (APART, UM)) for w in words.split()}
        self.closed |= {begin + end.strip("-"): THREAT for begin, ends in THREATS.items() for end in ends.split()}
        self.memo: dict[str, float] = {}

    def insult(self, word: str) -> float:
        """The weight of the longest entry that *word* begins with, 0 if none."""
        got = self.memo.get(word)
        if got is None:
            got = next((self.insults[word[:n]] for n in reversed(self.lengths) if word[:n] in self.insults and len(word) >= n), 0.0)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[word] = got
        return got

    def clauses(self, text: str) -> Iterator[tuple[str, float]]:
        """(kind, weight) of each match in each clause of *text*."""
        clause: list[tuple[str, float]] = []
        for token in [*_TOKEN.findall(text.lower()), "."]:
            if token not in _STOPS:
                known = self.closed.get(token)
                weight = 0.0 if known else self.insult(token)
                clause.append((known or (INSULT if weight else OTHER), VIOLENCE if known in (THREAT, BRING) else weight or 1.0))
                continue
            if any(s in (INSULT, THREAT, BRING) for s, _ in clause):
                state, heard = BACKWARD.start, []
                for symbol, weight in reversed(clause):
                    state, out = BACKWARD.step(state, symbol)
                    heard.append((out, weight))
                both = GRAMMAR.start
                for symbol, weight in reversed(heard):
                    both, out = GRAMMAR.step(both, symbol)
                    if out in KINDS:
                        yield out, weight
            clause = []

    def features(self, text: str | None) -> np.ndarray:
        """For each kind the summed squares of its matches' weights over the whole text, in units of UNIT, as far as MOST."""
        total = np.zeros(len(KINDS))
        low = (text or "").lower()
        seen = set(re.findall(r"\w+", low))
        # only texts with an insult or a threat have a clause that can match
        if any(self.insult(w) or self.closed.get(w) in (THREAT, BRING) for w in seen):
            for kind, weight in self.clauses(low):
                total[KINDS.index(kind)] += weight * weight
        return np.minimum(total / UNIT, MOST)

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ self.weights[:-1] + self.weights[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _ratio(a: int, b: int, n_a: int, n_b: int) -> float:
    """Log-likelihood ratio of being commoner among n_a than among n_b; 0 if it isn't."""
    if a * n_b <= b * n_a:
        return 0.0
    share = (a + b) / (n_a + n_b)
    return a * math.log(a / (n_a * share)) + (b * math.log(b / (n_b * share)) if b else 0.0)


def _once(samples: Iterable[tuple[str, int]]) -> list[tuple[str, int]]:
    """*samples* with one of each group of near copies: a third of the least hashes of their three-word runs agree."""
    out: list[tuple[str, int]] = []
    holders: dict[tuple[int, int], list[int]] = {}
    for text, y in samples:
        order = re.findall(r"[^\W\d_]+", text.lower())
        runs = {" ".join(order[i : i + 3]) for i in range(max(1, len(order) - 2))} if order else set()
        least = [(y, h) for h in sorted(zlib.crc32(r.encode("utf-8", "surrogatepass")) for r in runs)[:12]]
        shared = Counter(i for key in least for i in holders.get(key, ()))
        if shared and 3 * max(shared.values()) >= len(least):
            continue
        for key in least:
            holders.setdefault(key, []).append(len(out))
        out.append((text, y))
    return out


def learn_lexicon(samples: Iterable[tuple[str, int]]) -> dict[str, float]:
    """Prefixes that mark toxic texts, with their log odds; *samples* without copies.

    Each text counts once for each prefix of its words.  Prefixes are taken in order of
    evidence, the longer of equals, but for those that begin with one taken before, and those
    that have too little evidence beside the one taken that begins with them: so entries are
    whole stems, neither cut short nor split by their endings.
    """
    found: dict[int, Counter] = {0: Counter(), 1: Counter()}
    size = {0: 0, 1: 0}
    for text, y in samples:
        size[y] += 1
        found[y].update({w[:n] for w in set(re.findall(r"[^\W\d_]+", text.lower())) for n in range(SHORTEST, min(len(w), LONGEST) + 1)})
    n, m = size[1], size[0]
    good = {p: r for p, a in found[1].items() if a * m >= COMMONER * found[0][p] * n and (r := _ratio(a, found[0][p], n, m)) >= EVIDENCE}
    out: dict[str, float] = {}
    below: dict[str, tuple[int, int]] = {}  # of prefixes of entries: the texts of their commonest entry
    for p in sorted(good, key=lambda p: (-good[p], -len(p), p)):
        if any(p[:k] in out for k in range(SHORTEST, len(p))):
            continue
        a, b = found[1][p] - below.get(p, (0, 0))[0], found[0][p] - below.get(p, (0, 0))[1]
        if a * m >= COMMONER * b * n and _ratio(a, b, n, m) >= EVIDENCE:
            out[p] = math.log((a + 0.5) / (n + 1)) - math.log((b + 0.5) / (m + 1))
            for k in range(SHORTEST, len(p)):
                below[p[:k]] = max(below.get(p[:k], (0, 0)), (found[1][p], found[0][p]))
    return out


def fit(samples: list[tuple[str, int]]) -> Grammar:
    """A grammar whose lexicon and clause weights are learned from (text, 0 or 1).

    Clause weights: logistic regression by Newton steps with a Gaussian prior whose means let an
    aimed insult or a threat count most and a denied or reported one, or harm that nobody intends, little.  They are fitted to
    what a lexicon learned from the other half of the texts finds, so that words which only seem
    to mark toxic texts don't pass for certain.
    """
    samples = _once(samples)
    grammar = Grammar(learn_lexicon(samples))
    prior = np.array([1.5, 2.0, 0.2, 0.2, 7.0, 0.2, -3.0])
    grammar.weights = prior.copy()
    if not samples:
        return grammar
    by_class = sorted(range(len(samples)), key=lambda i: samples[i][1])
    half = {i: n % 2 for n, i in enumerate(by_class)}
    other = [Grammar(learn_lexicon([s for i, s in enumerate(samples) if half[i] != h])) for h in (0, 1)]
    x = np.array([np.append(other[half[i]].features(t), 1.0) for i, (t, _) in enumerate(samples)])
    y = np.array([label for _, label in samples], dtype=float)
    w = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) if 0 < y.mean() < 1 else np.ones(len(y))
    beta = prior.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (p - y)) + (beta - prior) * 0.5
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(beta))
        move = np.linalg.solve(hessian, gradient)
        beta = beta - move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-9))
    grammar.weights = beta
    return grammar


def learn(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS) -> Grammar:
    """Fit on at most *per_class* whole texts of each class of ``labels.toxic`` outside the held-out fold."""
    return fit(labelled_sample(documents, labels, "toxic", per_class, most_chars))


def score(documents: DataFrame, grammar: Grammar, text_col: str = "text", out_col: str = "_tox") -> DataFrame:
    """*documents* with *out_col* struct(score double, matches array<string>).

    The score (0 to 1) is that of all clauses of the whole text; ``matches`` has the kinds of
    clause that matched.  Null and empty texts have no clause and score as clean.
    """
    shared = Shared(documents.sparkSession, grammar)

    @F.pandas_udf("score double, matches array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.get()
        for batch in batches:
            found = [model.features(t) for t in batch]
            z = np.array(found).reshape(-1, len(KINDS)) @ model.weights[:-1] + model.weights[-1]
            yield pd.DataFrame({"score": 1 / (1 + np.exp(-z.clip(-30, 30))), "matches": [[k for k, v in zip(KINDS, f, strict=True) if v] for f in found]}, index=batch.index)

    return documents.withColumn(out_col, run(F.col(text_col)))
