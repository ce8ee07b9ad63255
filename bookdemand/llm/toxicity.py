"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon turns words into symbols (insult, threat, target, negation, reported speech,
other).  Five small transducers, composed, rewrite a clause's symbols: an insult near
its target becomes a directed one, a threat needs a target, what follows a negation or a
reporting verb is marked so.  The weights of a clause's final symbols are its score.
Insult words and stems are learned from labelled texts; a logistic curve over the
clauses' scores, fitted on the same texts, gives the probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import Shared, training_sample
from bookdemand.llm.simhash import majority, text_hashes

# Small word lists in English, German, French and Spanish.
TARGETS = frozenset("you your you're yourself them these those du dich dir euch eure vous toi votre tú usted ustedes vosotros".split())
NEGATIONS = frozenset("not never isn't aren't wasn't don't nicht kein keine niemals jamais pas nunca jamás".split())
REPORTS = frozenset("said says wrote called claimed according quoted quote sagte schrieb nannte behauptet déclare écrit selon dijo llamó escribió según".split())
THREATS = frozenset("kill murder strangle stab shoot töten umbringen erschießen tuer étrangler poignarder matar estrangular apuñalar".split())
INSULTS = frozenset("idiot idiots idiota moron stupid imbecile imbécile imbécil pathetic worthless scum loser trottel abschaum dummkopf ordure connard estúpido escoria".split())
SEED_WEIGHT = 2.0

CLAUSE_END = re.compile(r"[.!?;:\n]")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»]")
PREFIXES = tuple(range(3, 10))
WINDOW = 4  # words over which a negation, a report or a target reaches


@dataclass
class Transducer:
    """Rewrites symbols one by one.  ``step[state][symbol]`` is (next state, output); a
    symbol without an entry goes by the state's entry for "*", whose output None copies
    it.  Outputs may be delayed by nothing: the machine is sequential."""

    step: dict[int, dict[str, tuple[int, str | None]]]

    def run(self, symbols: list[str]) -> list[str]:
        state, out = 0, []
        for s in symbols:
            row = self.step[state]
            state, put = row.get(s) or row["*"]
            out.append(put or s)
        return out


def within(opener: str, marks: dict[str, str], reach: int) -> Transducer:
    """Marks symbols that follow ``opener`` within ``reach`` words."""
    step: dict[int, dict[str, tuple[int, str | None]]] = {0: {opener: (1, None), "*": (0, None)}}
    for k in range(1, reach + 1):
        after = k + 1 if k < reach else 0
        step[k] = {opener: (1, None), "*": (after, None)} | {s: (after, put) for s, put in marks.items()}
    return Transducer(step)


INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
DIRECTED, AIMED = "directed insult", "threat at target"
NEGATED = {INSULT: "negated insult", DIRECTED: "negated insult", THREAT: "negated threat", AIMED: "negated threat"}
REPORTED = {INSULT: "reported insult", DIRECTED: "reported insult", THREAT: "reported threat", AIMED: "reported threat"}

TARGET_BEFORE = within(TARGET, {INSULT: DIRECTED, THREAT: AIMED}, WINDOW)
NEGATION_BEFORE = within(NEGATION, NEGATED, WINDOW)
REPORT_BEFORE = Transducer({0: {REPORT: (1, None), "*": (0, None)}, 1: {"*": (1, None)} | {s: (1, put) for s, put in REPORTED.items()}})
# What one symbol adds: a factor on the insult's learned weight, or a weight of its own.
INSULT_FACTOR = {INSULT: 1.0, DIRECTED: 1.5, "negated insult": 0.4, "reported insult": 0.5}
THREAT_WEIGHT = {AIMED: 4.0, "negated threat": 0.3, "reported threat": 0.5}


def composed(symbols: list[str]) -> list[str]:
    """Target before or after, then negation, then reported speech, each on the last one's output."""
    symbols = TARGET_BEFORE.run(symbols)
    symbols = TARGET_BEFORE.run(symbols[::-1])[::-1]
    return REPORT_BEFORE.run(NEGATION_BEFORE.run(symbols))


@dataclass
class Grammar:
    words: dict[str, float] = field(default_factory=dict)  # insult words by weight
    stems: dict[str, float] = field(default_factory=dict)  # insult word beginnings by weight
    curve: tuple[float, float, float] = (-3.0, 1.0, 0.5)  # offset, slope on the log of the sum, on the best clause

    def insult(self, word: str) -> float:
        found = [self.stems[word[:n]] for n in PREFIXES if word[:n] in self.stems]
        if word in self.words:
            found.append(self.words[word])
        return max(found, default=0.0)

    def clause_score(self, clause: str) -> float:
        words = WORD.findall(clause)
        weights = [self.insult(w) for w in words]
        symbols = [INSULT if x else THREAT if w in THREATS else TARGET if w in TARGETS else NEGATION if w in NEGATIONS
                   else REPORT if w in REPORTS or w in "\"“”«»" else OTHER for w, x in zip(words, weights)]
        return sum(x * INSULT_FACTOR.get(s, 1.0) if x else THREAT_WEIGHT.get(s, 0.0) for s, x in zip(composed(symbols), weights))

    def finder(self):
        """An automaton of everything that can make a clause score."""
        machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for w in {*self.words, *self.stems, *THREATS}:
            machine.add_word(w)
        machine.make_automaton()
        return machine

    def features(self, text: str | None, machine) -> tuple[float, float]:
        """log(1 + sum of clause scores), and the best clause's score (at most 6)."""
        lower, total, best, done = (text or "").lower(), 0.0, 0.0, 0
        for last, size in machine.iter(lower):
            start = last - size + 1
            if start < done or start and lower[start - 1].isalpha():
                continue
            begin = done
            for m in CLAUSE_END.finditer(lower, done, start):
                begin = m.end()
            end = CLAUSE_END.search(lower, start)
            done = end.end() if end else len(lower)
            score = self.clause_score(lower[begin:done])
            total, best = total + score, max(best, score)
        return math.log1p(total), min(best, 6.0)

    def probability(self, x: tuple[float, float]) -> float:
        z = self.curve[0] + self.curve[1] * x[0] + self.curve[2] * x[1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def one_of_each(rows: list[tuple[str, int]], bits: int = 8) -> list[tuple[str, int]]:
    """The sample without near copies, so that a copied text does not vote twice."""
    prints = np.array([majority(text_hashes(t, 3, 42)) for t, _ in rows], np.uint64)
    gone = np.zeros(len(rows), bool)
    for k in range(len(rows)):
        if not gone[k]:
            gone[k + 1:] |= np.bitwise_count(prints[k + 1:] ^ prints[k]) <= bits
    return [r for r, g in zip(rows, gone) if not g]


def cover(rows: list[tuple[str, int]], support: int, precision: float, needed: int = 3) -> Iterator[tuple[tuple[str, str], int, int]]:
    """Words and stems that explain the toxic texts: again and again the one found in most
    toxic texts that lack ``needed`` explanations (ties: words, then longer ones), among
    those with enough support and precision.  What merely occurs beside them explains
    nothing new and stays out.  Yields (kind, text), toxic and other texts with it."""
    def features(text: str) -> set[str]:
        """Words, and their beginnings with a star."""
        words = set(re.findall(r"[^\W\d_]+", text.lower()))
        return {w for w in words if len(w) >= 3} | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}

    seen: Counter = Counter()
    for text, y in rows:
        if y:
            seen.update(features(text))
    likely = {f for f, n in seen.items() if n >= support}
    del seen  # most features occur once; the sample's other texts only count the rest
    good: dict[str, set[int]] = {f: set() for f in likely}
    others: Counter = Counter()
    for k, (text, y) in enumerate(rows):
        if y:
            for f in features(text) & likely:
                good[f].add(k)
        else:
            others.update(features(text) & likely)
    good = {f: at for f, at in good.items() if len(at) >= precision * (len(at) + others[f])}
    lacking = Counter({k: needed for k, (_, y) in enumerate(rows) if y})
    while good:
        gains = {f: sum(1 for k in at if lacking[k] > 0) for f, at in good.items()}
        best = max(good, key=lambda f: (gains[f], f[-1] != "*", len(f), f))
        if gains[best] < support:
            return
        stem = best.rstrip("*")
        yield ("stem" if best[-1] == "*" else "word", stem), len(good[best]), others[best]
        for k in good[best]:
            lacking[k] -= 1
        good = {f: at for f, at in good.items() if gains[f] >= support and not f.startswith(stem) and not stem.startswith(f.rstrip("*"))}


def learn(rows: list[tuple[str, int]], support: int = 4, precision: float = 0.9) -> Grammar:
    """Insult words and stems: those in at least ``support`` texts, of which a share of at
    least ``precision`` is toxic; the weight grows with the odds.  Then the curve, by
    Newton's method on the log loss.  Without texts of both kinds, only the fixed lists."""
    grammar = Grammar(dict.fromkeys(INSULTS, SEED_WEIGHT))
    rows = one_of_each(rows)
    target = np.array([y for _, y in rows], float)
    if not len(rows) or target.min() == target.max():
        return grammar
    size = [max(1, int((target == 0).sum())), max(1, int((target == 1).sum()))]
    for (kind, w), n, other in cover(rows, support, precision):
        weight = min(4.0, math.log((n + 0.5) / (size[1] + 1)) - math.log((other + 0.5) / (size[0] + 1)))
        table = grammar.words if kind == "word" else grammar.stems
        table[w] = max(weight, table.get(w, 0.0))
    machine = grammar.finder()
    x = np.array([(1.0, *grammar.features(t, machine)) for t, _ in rows])
    beta = np.array([-3.0, 1.0, 0.5])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - target) + 0.2 * beta * [0, 1, 1]
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 0.2, 0.2])
        move = np.linalg.solve(curve, gradient)
        beta = beta - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    grammar.curve = tuple(float(b) for b in beta)
    return grammar


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", max_rows: int = 8000,
        max_chars: int = 20_000) -> Grammar:
    """A grammar learned from a bounded sample: at most ``max_rows`` labelled texts of at most
    ``max_chars`` characters, picked by a hash of doc_id among the rows ``allowed`` admits."""
    return learn(training_sample(docs, labels, label, allowed, max_rows, max_chars))


def score(docs: DataFrame, grammar: Grammar, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the probability of label 1 for the whole text.

    Null and empty texts have no clause and get the score of a text without matches; all
    rows and columns stay (a column that already has the name is replaced).
    """
    shared = Shared(docs.sparkSession, grammar)  # bounded by the training sample

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = shared.value.finder()
        for part in texts:
            yield pd.Series([shared.value.probability(shared.value.features(t, machine)) for t in part], dtype="float64")

    return docs.withColumn(name, run(F.col("text").cast("string")))
