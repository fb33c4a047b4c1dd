"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer reads the words of a clause and writes classes: insult,
threat, target, negation, reported speech, or other. Its insult arcs (whole
words and word beginnings) are learned from the clauses of a bounded sample of
labelled texts and weigh the probability that they are no chance find among all
words of the sample; its other arcs are the fixed lists below and weigh 1. Three more transducers read the classes: negation
marks what follows within its scope, reported speech marks the rest of the
clause, target notes who is addressed. They are composed into one machine and
compiled to tables. An accepted path ends at an insult or threat, or at the
target that follows one, and weighs

    arc * hit[class] * negated? * reported? * (stated or targeted?)

(factors; logarithms add up along the path). A hit is targeted if its clause
names a target, stated in any other clause of at least ``STATEMENT`` words.
Paths are added up, over a text's clauses too, to the odds that the text is
toxic. The factors are fitted to the sample within bounds that keep the
grammar's meaning whatever the labels say: a word alone, or in a few words that
aim at nobody, stays under the threshold; a target lifts it above; negation or
reported speech takes away at least what a target or statement adds. What an
insult in a statement counts is left to the labels. So several insults, or one
aimed at someone, make a text toxic, and an isolated word does not.

Defined cases: null and empty texts have no clause and the score of no path;
a clause ends with a word that ends in ``.!?;:`` or with a line; null
and repeated ids are scored row by row; without labelled rows the factors of
``PRIOR`` and the fixed lists are used; an empty table gives no rows; further columns
are ignored by ``predict`` and kept by ``reject``. Sampled clauses that occur
in several texts count once, and as clean if any of these texts is clean.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from implicit_rank.llm import common, words

SAMPLE_DOCS = 8_000       # at most so many labelled texts are learned from; every arc of theirs that is one is kept
PREFIXES = (4, 5, 6, 7, 8)  # lengths of word beginnings that may be an arc
LEAST, SUPPORT = 3, 0.01  # toxic clauses that an insult arc needs: so many, and this share of the number of toxic texts
SHARE = 0.95              # share of toxic ones among the clauses of a word's arc; a beginning's has no others
SCOPE = 3                 # words that a negation reaches
THRESHOLD = 0.3

STATEMENT = 5             # words that make a clause a statement

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, OPENING = range(7)
CLASSES = 7               # OPENING stands before the first word of a statement
ALONE, STATED, TARGETED = range(3)

# Cue words by class, in English, German, French and Spanish.
CUES = {
    THREAT: "kill hurt destroy beat burn shoot stab hunt crush smash strangle töten schlagen umbringen tuer frapper "
            "brûler matar golpear quemar destruir",
    TARGET: "you your yours yourself u ur he she they them him her their du dich dir ihr euch sie er dein deine tu toi "
            "te vous ton ta votre il elle ils elles tú ti usted ustedes vosotros él ella ellos tus",
    NEGATION: "not no never isn't aren't don't doesn't won't wasn't weren't nobody none without nicht kein keine nie "
              "niemals ohne pas jamais aucun sans nunca jamás ningún ninguna sin",
    REPORT: "said says say claimed claims reported reports wrote writes quoted according allegedly called calls sagte "
            "sagt schrieb behauptete laut dit disait écrit selon dijo dice escribió según",
}
PUNCTUATION = "\"'`.,;:!?()[]{}<>«»“”‘’…*_-–—/|¿¡"
CLAUSE_ENDS = tuple(".!?;:")


class Transducer:
    """A deterministic transducer given by its start state and step(state, symbol)."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        """Composition: ``other`` reads what this one writes."""
        def step(state, symbol):
            mine, out = self.step(state[0], symbol)
            theirs, out = other.step(state[1], out)
            return (mine, theirs), out
        return Transducer((self.start, other.start), step)

    def compile(self, symbols) -> tuple[list[list[int]], list[list]]:
        """(next state, output) tables over the states reachable from the start."""
        states, after, outputs = [self.start], [], []
        for state in states:  # grows while it is read
            row, outs = [], []
            for symbol in symbols:
                follows, out = self.step(state, symbol)
                if follows not in states:
                    states.append(follows)
                row.append(states.index(follows))
                outs.append(out)
            after.append(row)
            outputs.append(outs)
        return after, outputs


HITS = (INSULT, THREAT)


def _negation(left: int, symbol):
    """Marks hits within SCOPE words after a negation; symbols become (class, negated)."""
    if symbol == NEGATION:
        return SCOPE, (symbol, False)
    return max(0, left - 1), (symbol, symbol in HITS and left > 0)


def _reported(inside: bool, symbol):
    """Marks hits after a verb of speech; symbols become (class, negated, reported)."""
    return inside or symbol[0] == REPORT, (*symbol, symbol[0] in HITS and inside)


def _target(state, symbol):
    """Writes an event for a hit: (class, negated, reported, aim), else None.

    The aim is TARGETED if a target stands before the hit or, once more, after
    it; else STATED in a statement; else ALONE.
    """
    aim, pending = state
    if symbol[0] == OPENING:
        return (STATED, None), None
    if symbol[0] == TARGET:
        return (TARGETED, None), (*pending, TARGETED) if pending else None
    if symbol[0] in HITS:
        return (aim, None if aim == TARGETED else symbol), (*symbol, aim)
    return state, None


GRAMMAR = Transducer(0, _negation).then(Transducer(False, _reported)).then(Transducer((ALONE, None), _target))
EVENTS = list(product(HITS, (False, True), (False, True), (ALONE, STATED, TARGETED)))


def _tables() -> tuple[list[list[int]], list[list[int]]]:
    after, outputs = GRAMMAR.compile(range(CLASSES))
    return after, [[EVENTS.index(x) if x else -1 for x in row] for row in outputs]


AFTER, EMITS = _tables()
# Logarithms of the factors: no path, hit by class (in order of HITS), negated, reported, stated, targeted.
PRIOR = np.log([0.02, 0.3, 0.15, 0.1, 0.1, 1.2, 6.0])
LOW = np.log([1e-4, 0.1, 0.1, 0.01, 0.01, 1.0, 4.5])
HIGH = np.log([0.02, 0.38, 0.2, 0.11, 0.11, 9.0, 9.0])
FACTORS = np.array([[*(e[0] == h for h in HITS), e[1], e[2], e[3] == STATED, e[3] == TARGETED] for e in EVENTS], float)


def _odds(mass: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Odds of texts from the summed arc weights of their paths by event (texts x events)."""
    return np.exp(factors[0]) + mass @ np.exp(FACTORS @ factors[1:])


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)     # insult arcs: whole word -> weight
    prefixes: dict[str, float] = field(default_factory=dict)  # word beginning -> weight
    factors: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def __post_init__(self):
        cues = {w: (c, 1.0) for c, text in CUES.items() for w in text.split()}
        self.known = {**cues, **{w: (INSULT, weight) for w, weight in self.words.items()}}
        self.lengths = sorted({len(p) for p in self.prefixes}, reverse=True)

    def arc(self, word: str) -> tuple[int, float]:
        """(class, weight) of the arc that reads a word: its own, or its longest beginning's."""
        if (found := self.known.get(word)) is not None:
            return found
        for n in self.lengths:
            if len(word) >= n and (weight := self.prefixes.get(word[:n])) is not None:
                return INSULT, weight
        return OTHER, 0.0

    def classify(self, vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, arc weight, ends a clause) of each distinct word."""
        arcs = [self.arc(raw.strip(PUNCTUATION).lower()) for raw in vocabulary]
        return (np.array([c for c, _ in arcs], np.int8), np.array([w for _, w in arcs], float),
                np.array([raw.endswith(CLAUSE_ENDS) for raw in vocabulary], bool))

    def matches(self, texts: pa.Array):
        """(text number, first word, last word + 1, {event: summed arc weights}) of each clause with a hit,
        and the distinct words and codes they refer to."""
        vocabulary, codes, offsets = words.split_words(texts)
        distinct = common.strings(vocabulary)
        classes, weights, ends = self.classify(distinct)
        of_word, weight_of = classes[codes], weights[codes]
        stops = np.union1d(np.flatnonzero(ends[codes]) + 1, offsets)
        hits = np.flatnonzero(np.isin(of_word, HITS))
        clauses = np.unique(np.searchsorted(stops, hits, side="right"))
        found = []
        for c in clauses.tolist():
            lo, hi = int(stops[c - 1]), int(stops[c])
            n_words = hi - lo - (distinct[codes[hi - 1]] == ".")  # a line end stands as the word "."
            state, weight, events = AFTER[0][OPENING] if n_words >= STATEMENT else 0, 0.0, {}
            for symbol, arc in zip(of_word[lo:hi].tolist(), weight_of[lo:hi].tolist()):
                event = EMITS[state][symbol]
                state = AFTER[state][symbol]
                if symbol in HITS:
                    weight = arc
                if event >= 0:  # at the hit, or at the target after the last hit
                    events[event] = events.get(event, 0.0) + weight
            found.append((int(np.searchsorted(offsets, lo, side="right")) - 1, lo, hi, events))
        return found, distinct, codes

    def mass(self, texts: pa.Array) -> np.ndarray:
        """Summed arc weights of the paths by event, a row per text."""
        mass = np.zeros((len(texts), len(EVENTS)))
        for row, _, _, events in self.matches(texts)[0]:
            for event, weight in events.items():
                mass[row, event] += weight
        return mass

    def score(self, mass: np.ndarray) -> np.ndarray:
        odds = _odds(mass, self.factors)
        return odds / (1 + odds)


def _arcs_of(clause: str) -> set[str]:
    """Candidate arcs of a clause: whole words ``=word`` and beginnings."""
    out = set()
    for raw in set(clause.lower().split()):
        word = raw.strip(PUNCTUATION)
        if word.isalpha():
            out.add("=" + word)
            out.update(word[:n] for n in PREFIXES if len(word) >= n)
    return out


def select_arcs(toxic: dict[str, int]) -> set[str]:
    """The arcs kept of those given with their numbers of toxic clauses.

    A beginning gives way if one longer arc holds 95 % of its clauses: it says
    no more than that arc, and would take further words for insults.
    """
    longest: dict[str, int] = {}
    for arc, n in toxic.items():
        word = arc.lstrip("=")
        for size in PREFIXES:
            if len(word) > size or (arc[0] == "=" and len(word) == size):
                longest[word[:size]] = max(n, longest.get(word[:size], 0))
    return {a for a, n in toxic.items() if a[0] == "=" or longest.get(a, 0) < 0.95 * n}


def arc_weight(toxic: int, n: int, chance: float, arcs: int) -> float:
    """Probability that an arc stands for an insult: one of ``arcs`` does beforehand, and its clauses
    are toxic by ``SHARE``; those of any other arc are by ``chance``."""
    evidence = toxic * np.log(SHARE / chance) + (n - toxic) * np.log((1 - SHARE) / (1 - chance)) - np.log(arcs)
    return float(common.sigmoid(evidence))


def _fit(mass: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Factors of the greatest likelihood within their bounds, with a weak prior, by steps along one factor at a time."""
    def loss(factors: np.ndarray) -> float:
        odds = _odds(mass, factors)
        return (np.log1p(odds) - y * np.log(odds)).sum() + 0.5 * ((factors - PRIOR) ** 2).sum()

    best, step = PRIOR.copy(), 1.0
    least = loss(best)
    while step > 1e-3:
        before = least
        for i in range(len(best)):
            for sign in (1, -1):
                tried = best.copy()
                tried[i] = np.clip(tried[i] + sign * step, LOW[i], HIGH[i])
                if (found := loss(tried)) < least:
                    best, least = tried, found
        if least >= before:
            step /= 2
    return best


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE_DOCS) -> Model:
    """Learn the insult arcs from the clauses of the bounded sample, then the factors from its texts."""
    sample = common.save(common.labelled_texts(docs, labels, label, bound).drop("doc_id").distinct(), "toxic-sample")
    spark = docs.sparkSession
    least = max(LEAST, SUPPORT * (sample.agg(F.sum("y")).first()[0] or 0))
    clauses = sample.select(F.explode(F.split("text", r"(?<=[.!?;:])\s+|\n")).alias("text"), "y")
    clauses = clauses.groupBy("text").agg(F.min("y").alias("y"))  # copies and shared passages count once

    def count(batches):
        for chunk in common.text_chunks(batches):
            n, toxic = Counter(), Counter()
            for text, y in zip(chunk.column("text").to_pylist(), chunk.column("y").to_pylist()):
                arcs = _arcs_of(text) | {""}  # the empty arc counts the clauses
                n.update(arcs)
                if y:
                    toxic.update(arcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([toxic[a] for a in n], pa.int64())], names=["arc", "n", "toxic"])

    counts = common.save(clauses.mapInArrow(count, "arc string, n long, toxic long").groupBy("arc")
                         .agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")), "toxic-arcs")
    few = F.when(F.col("arc").startswith("="), SHARE).otherwise(1.0) * F.col("n")
    # words of the bounded sample that hardly occur in clean clauses
    rows = counts.filter((F.col("arc") != "") & (F.col("toxic") >= least) & (F.col("toxic") >= few)).collect()
    every = counts.filter("arc = ''").first()
    chance = np.clip(every["toxic"] / every["n"], 1e-6, 0.5) if every else 0.5
    arcs = counts.count()
    kept = select_arcs({r["arc"]: r["toxic"] for r in rows})
    weights = {r["arc"]: arc_weight(r["toxic"], r["n"], chance, arcs) for r in rows if r["arc"] in kept}
    model = Model({a[1:]: w for a, w in weights.items() if a[0] == "="}, {a: w for a, w in weights.items() if a[0] != "="})
    shared = spark.sparkContext.broadcast(model)  # bounded as ``rows``

    def sums(batches):
        for chunk in common.text_chunks(batches):
            mass = shared.value.mass(common.texts_of(chunk))
            yield pa.RecordBatch.from_arrays([pa.array(list(mass), pa.list_(pa.float64())), common.one_array(chunk.column("y"))],
                                             names=["mass", "y"])

    data = sample.mapInArrow(sums, "mass array<double>, y int").toArrow()  # at most ``bound`` short rows
    if data.num_rows:
        model.factors = _fit(np.array(data.column("mass").to_pylist()), data.column("y").to_numpy().astype(float))
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, odds): the probability, and the odds that the paths of all clauses add up to."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for chunk in common.text_chunks(batches):
            mass = shared.value.mass(common.texts_of(chunk))
            yield pa.RecordBatch.from_arrays(
                [common.one_array(chunk.column("doc_id")), pa.array(shared.value.score(mass)),
                 pa.array(_odds(mass, shared.value.factors))], names=["doc_id", "score", "odds"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, odds double")


def clauses(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, clause, weight): every clause with a hit, and the logarithm of its paths' sum."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        of_event = np.exp(FACTORS @ shared.value.factors[1:])
        for chunk in common.text_chunks(batches):
            found, distinct, codes = shared.value.matches(common.texts_of(chunk))
            rows = np.array([f[0] for f in found], np.int64)
            sums = [sum(of_event[e] * w for e, w in events.items()) for *_, events in found]
            yield pa.RecordBatch.from_arrays(
                [common.one_array(chunk.column("doc_id")).take(pa.array(rows)),
                 pa.array([" ".join(distinct[c] for c in codes[lo:hi]) for _, lo, hi, _ in found], pa.string()),
                 pa.array(np.log(np.array(sums, float)))],
                names=["doc_id", "clause", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, clause string, weight double")


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, columns unchanged; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for chunk in common.text_chunks(batches):
            keep = shared.value.score(shared.value.mass(common.texts_of(chunk))) < threshold
            yield from chunk.filter(pa.array(keep)).to_batches()

    return docs.mapInArrow(run, docs.schema)
