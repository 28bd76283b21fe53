"""Toxicity by a weighted finite-state pattern grammar.

Every word becomes a symbol: insult, threat, target, negation, reported speech, modal verb, degree, other. Which words insult, and how
strongly, is learned from labelled rows: starts of words (2 to 8 letters, or the whole word) that stand in far more
toxic than clean documents, with their log odds as weights. Words for targets, negation, reported speech, modal verbs and
degree are fixed lists of four languages, threats are the forms of fixed verbs. What a threat near a person weighs is the log
odds of the labelled documents that have one.

The symbols of a clause run backwards through a transducer that marks insults and threats with a *target* behind them, and
then forwards through a cascade of five weighted ones, composed into one machine:

- *insult* strengthens insults shortly after a word of degree,
- *threat* strengthens threat verbs shortly after a modal verb,
- *negation* marks insults and threats shortly after a negation,
- *reported speech* marks what follows a verb of saying in the clause,
- *target* marks what stands near a person that is spoken to or about, before or behind; a threat verb without one counts
  little.

A mark multiplies the weight of the insult or threat that it falls on. A clause's score is the sum over its marked words;
clauses without insult or threat are not matched at all. A document's score is a logistic function of its strongest clause,
the sum over its clauses and their share of the text, fitted on the same labelled rows.

Bounds: ``per_class`` labelled documents of either class to learn from, ``lexicon`` word starts. Null texts are empty;
texts without a matched clause, empty ones too, get the score of no match. Rows are scored apart, so repeated rows get equal
scores. Without toxic labels every score is 0. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import held_out, in_slices, training_sample

PER_CLASS = 6000
LEXICON = 2000

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
MODAL, DEGREE = "modal", "degree"
# Insults and threats with a target behind them.
INSULT_AT, THREAT_AT = "insult at", "threat at"

# The closed word classes of the grammar, in English, German, French and Spanish.
WORDS = {
    TARGET: "you your he she they him her them du dich ihr euch er sie toi tu vous il elle eux tú usted él ella ellos",
    NEGATION: "not no never neither isn't aren't don't nicht kein keine nie ne pas jamais aucun nunca jamás ningún",
    REPORT: "said says say called wrote claims claimed quoted sagt sagte nannte dit disait écrit dijo dice llamó escribió",
    MODAL: "will shall must should gonna going i'll we'll werde werden wird wirst soll vais vas va allons vont voy vamos van",
    DEGREE: "such so total complete absolute utter völliger totaler so'n si tellement gros espèce tan gran puro",
}

# Fixed value: threat verbs in the same languages, stems with their endings.
_THREAT = re.compile(
    r"(kill|destroy|punish|murder)(s|es|ed|ing)?|hurt(s|ing)?"
    r"|töte(n|t|st|te|ten)?|(er)?schl(ag|äg|ug)(e|en|t|st)?|zerstör(e|en|t|st|te|ten)"
    r"|tu(er|e|es|ez|é|erai|eras|era|erons)|frapp(er|e|es|ez|é|erai|era|erons)|détrui(re|s|t|sez|sons|sent|rai|ra|rons)"
    r"|mat(ar|o|a|as|é|aré|ará|aremos|ando)|golpe(ar|o|a|as|é|aré|ará|aremos|ando)|destru(ir|yo|ye|yes|iré|irá|iremos|yendo)"
)

_CLAUSE = re.compile(r"[.!?;:\n|]+")


def words_of(text: str) -> list[str]:
    """The words of all clauses: a mark that ends a clause also ends a word, with or without a blank."""
    return _CLAUSE.sub(" ", text).split()


_BARE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


@dataclass
class Transducer:
    """Deterministic and weighted: ``(state, symbol) -> (state, output, factor)``. A pair that is not listed passes the
    symbol on, with factor 1, to the state that ``idle`` gives (the same state where it is not listed)."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)
    idle: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        arc = self.arcs.get((state, symbol))
        return arc if arc else (self.idle.get(state, state), symbol, 1.0)


def within(opener: str, marked: tuple[str, ...], reach: int, factor: float) -> Transducer:
    """Multiplies ``marked`` symbols by ``factor`` while an ``opener`` stands at most ``reach`` symbols back; a reach of 0
    holds to the end of the clause. State *k* means the opener reaches *k* symbols further."""
    top = reach or 1
    arcs = {(s, opener): (top, opener, 1.0) for s in range(top + 1)}
    idle = {s: s - 1 for s in range(1, top + 1)} if reach else {}
    for s in range(1, top + 1):
        for m in marked:
            arcs[s, m] = (s - 1 if reach else s, m, factor)
    return Transducer(0, arcs, idle)


def compose(first: Transducer, second: Transducer, symbols: tuple[str, ...]) -> Transducer:
    """One machine that feeds the first one's output to the second; factors multiply. States are numbered as reached."""
    numbers = {(first.start, second.start): 0}
    open_, arcs = [(first.start, second.start)], {}
    while open_:
        pair = open_.pop()
        for symbol in symbols:
            s, middle, x = first.step(pair[0], symbol)
            t, out, y = second.step(pair[1], middle)
            if (s, t) not in numbers:
                numbers[s, t] = len(numbers)
                open_.append((s, t))
            arcs[numbers[pair], symbol] = (numbers[s, t], out, x * y)
    return Transducer(0, arcs)


SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, MODAL, DEGREE, INSULT_AT, THREAT_AT, OTHER)

# Words between a target and what it marks, counted with the latter.
REACH = 4


def target_behind() -> Transducer:
    """Runs over a reversed clause: turns hostile symbols into those that have a target at most ``REACH`` symbols behind."""
    machine = within(TARGET, (), REACH, 1.0)
    for s in range(1, REACH + 1):
        machine.arcs[s, INSULT] = (s - 1, INSULT_AT, 1.0)
        machine.arcs[s, THREAT] = (s - 1, THREAT_AT, 1.0)
    return machine


def targets(targeted: float, bare: float) -> Transducer:
    """Marks hostile symbols with a target before or behind, once; threats without one are multiplied by ``bare``."""
    machine = within(TARGET, (INSULT, THREAT), REACH, targeted)
    machine.arcs[0, THREAT] = (0, THREAT, bare)
    for s in range(REACH + 1):
        for m in (INSULT_AT, THREAT_AT):
            machine.arcs[s, m] = (max(0, s - 1), m, targeted)
    return machine


def grammar(
    *,
    negated: float = 0.5,
    reported: float = 0.7,
    targeted: float = 1.3,
    degree: float = 1.2,
    modal: float = 1.2,
    bare: float = 0.3,
) -> Transducer:
    hostile = (INSULT, THREAT, INSULT_AT, THREAT_AT)
    parts = (
        within(DEGREE, (INSULT, INSULT_AT), 2, degree),
        within(MODAL, (THREAT, THREAT_AT), 3, modal),
        within(NEGATION, hostile, 3, negated),
        within(REPORT, hostile, 0, reported),
        targets(targeted, bare),
    )
    machine = parts[0]
    for part in parts[1:]:
        machine = compose(machine, part, SYMBOLS)
    return machine


class Grammar:
    """Finds and scores the clauses of a text."""

    # Where labelled documents have too few threats to tell.
    THREAT_WEIGHT = 0.5
    REMEMBERED = 400_000

    def __init__(self, lexicon: dict[str, float], machine: Transducer | None = None, *, threat: float | None = None) -> None:
        self.lexicon, self.machine, self.behind = lexicon, machine or grammar(), target_behind()
        self.threat = self.THREAT_WEIGHT if threat is None else threat
        self.longest = max([len(s) for s in lexicon], default=0)
        self.closed = {w: symbol for symbol, words in WORDS.items() for w in words.split()}
        self.seen: dict[str, tuple[str, float]] = {}

    def symbol(self, raw: str) -> tuple[str, float]:
        """Symbol and weight of a word with its marks."""
        word = _BARE.sub("", raw).lower()
        starts = [word[:k] for k in range(2, min(len(word), self.longest) + 1)] + [f"{word}$"]
        if weight := max((self.lexicon.get(s, 0.0) for s in starts), default=0.0):
            return INSULT, weight
        if _THREAT.fullmatch(word):
            return THREAT, self.threat
        return self.closed.get(word, OTHER), 0.0

    def clauses(self, text: str) -> list[float]:
        """Scores of the matched clauses, in order."""
        if len(self.seen) > self.REMEMBERED:
            self.seen.clear()
        raw = words_of(text)
        for w in set(raw).difference(self.seen):
            self.seen[w] = self.symbol(w)
        if not any(self.seen[w][1] for w in set(raw)):
            return []
        scores = []
        for clause in _CLAUSE.split(text):
            found = [self.seen.get(w) or self.symbol(w) for w in clause.split()]
            if not any(weight for _, weight in found):
                continue
            state, score = self.machine.start, 0.0
            for symbol, (_, weight) in zip(self.marked([symbol for symbol, _ in found]), found, strict=True):
                state, _, factor = self.machine.step(state, symbol)
                score += weight * factor
            if score:
                scores.append(score)
        return scores

    def marked(self, symbols: list[str]) -> list[str]:
        """The symbols of a clause, with targets behind insults and threats marked."""
        state, out = self.behind.start, []
        for symbol in reversed(symbols):
            state, symbol, _ = self.behind.step(state, symbol)
            out.append(symbol)
        return out[::-1]

    def threatens(self, text: str) -> bool:
        """Whether a threat verb has a target before or behind it in its clause."""
        for clause in _CLAUSE.split(text):
            symbols = [self.symbol(w)[0] for w in clause.split()] if _THREAT.search(clause.lower()) else []
            if THREAT in symbols:
                sides = self.marked(symbols), self.marked(symbols[::-1])
                if any(THREAT_AT in side for side in sides):
                    return True
        return False

    def features(self, text: str) -> np.ndarray:
        scores = self.clauses(text)
        if not scores:
            return np.array([1.0, 0.0, 0.0, 0.0])
        words = len(words_of(text))
        return np.array([1.0, max(scores), math.log1p(sum(scores)), math.log1p(100 * sum(scores) / words)])


def word_starts(text: str) -> set[str]:
    """Starts of the text's words, and the whole words with an end mark."""
    out = set()
    for word in {_BARE.sub("", w).lower() for w in set(words_of(text))}:
        out.update(word[:k] for k in range(2, min(len(word), 8) + 1))
        out.add(f"{word}$")
    return out


# Stands for a threat near a person among the counted word starts; no word starts with a mark.
_THREATENS = "!threat"


def learn_lexicon(
    sample: DataFrame, *, lexicon: int = LEXICON, support: int = 5, odds: float = 12.0
) -> tuple[dict[str, float], float | None]:
    """Word starts with the log odds of toxic against clean documents of the sample. The executors count; what comes to
    the driver is at most ``lexicon`` rows. A start is taken if ``support`` toxic documents have it and its odds, with the
    counts set back by their spread, are above ``odds``. Beside them the log odds of documents with a threat near a person, 0
    at least; None where fewer than ``support`` documents have one."""
    totals = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    if not totals.get(1):
        return {}, None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = Grammar({})
        for batch in in_slices(batches, 1024):
            toxic, clean = Counter(), Counter()
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                (toxic if y else clean).update(word_starts(text) | ({_THREATENS} if plain.threatens(text) else set()))
            starts = list(toxic.keys() | clean.keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(starts, pa.string()),
                    pa.array([toxic[s] for s in starts], pa.int64()),
                    pa.array([clean[s] for s in starts], pa.int64()),
                ],
                ["start", "toxic", "clean"],
            )

    n1, n0 = totals[1], totals.get(0, 0)
    counted = (
        sample.select("text", "y")
        .mapInArrow(count, "start string, toxic long, clean long")
        .groupBy("start")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.length("start") >= 2) & ((F.col("toxic") >= support) | (F.col("start") == _THREATENS)))
    )
    share = (F.col("toxic") - F.sqrt("toxic")) / n1
    against = (F.col("clean") + F.sqrt("clean") + 0.5) / (n0 + 1)
    weighed = counted.withColumn("odds", share / against).filter((F.col("odds") > odds) | (F.col("start") == _THREATENS))
    rows = weighed.orderBy(F.col("start") != _THREATENS, F.desc("toxic"), "start").limit(lexicon + 1).collect()
    found = {r.start: (r.toxic, r.clean) for r in rows}
    toxic, clean = found.pop(_THREATENS, (0, 0))
    threat = max(0.0, log_odds(toxic, clean, n1, n0)) if toxic + clean >= support else None
    return weigh_starts(dict(list(found.items())[:lexicon]), n1, n0), threat


def log_odds(toxic: int, clean: int, n1: int, n0: int) -> float:
    return math.log((toxic + 0.5) / (n1 + 1) * (n0 + 1) / (clean + 0.5))


def weigh_starts(found: dict[str, tuple[int, int]], n1: int, n0: int) -> dict[str, float]:
    """Log odds by word start. A start of which nearly all toxic uses go on in one way is left to the longer start, so that
    other words that begin alike are not taken for insults."""
    uses: dict[str, int] = {}
    for start, (toxic, _) in found.items():
        for k in range(1, len(start)):
            uses[start[:k]] = max(uses.get(start[:k], 0), toxic)
    return {
        start: log_odds(toxic, clean, n1, n0)
        for start, (toxic, clean) in found.items()
        if uses.get(start, 0) < 0.8 * toxic
    }


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients by Newton's method; the first column is the constant and is not shrunk."""
    beta = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge * weights.sum() / len(weights))
    shrink[0] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (y - p)) - shrink * beta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-9)
        move = np.linalg.solve(curve, slope)
        beta += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def fit_on(sample: DataFrame, counts: dict[int, int], *, lexicon: int = LEXICON) -> tuple[dict[str, float], float | None, np.ndarray] | None:
    """Lexicon, weight of threats and coefficients from the rows of ``training_sample``; None where toxic ones show neither
    insults nor threats."""
    words, threat = learn_lexicon(sample, lexicon=lexicon)
    if not words and not threat:
        return None

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Grammar(words, threat=threat)
        for batch in in_slices(batches, 1024):
            rows = [found.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(rows, pa.list_(pa.float64()))], ["y", "x"])

    # Bounded: four numbers for each row of the sample.
    rows = sample.select("text", "y").mapInArrow(measure, "y int, x array<double>").collect()
    y = np.array([r.y for r in rows], float)
    x = np.array([r.x for r in rows])
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    total = sum(counts.values())
    weights = np.where(y == 1, counts.get(1, 0) / total / y.mean(), counts.get(0, 0) / total / max(1e-9, 1 - y.mean()))
    return words, threat, fit_logistic(x, y, weights)


def score_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    folds: int = 4,
    fold: int = 2,
    per_class: int = PER_CLASS,
    lexicon: int = LEXICON,
    threshold: float = 0.3,
) -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``score`` and ``predicted``. Learns only from
    labels outside the held-out fold; ids serve to find labels and the fold, never as inputs of a score."""
    sample, counts = training_sample(documents, labels, label, folds=folds, fold=fold, per_class=per_class)
    model = documents.sparkSession.sparkContext.broadcast(fit_on(sample, counts, lexicon=lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Grammar(model.value[0], threat=model.value[1]) if model.value else None
        for batch in in_slices(batches, 512):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if found:
                x = np.array([found.features(t) for t in texts])
                scores = 1 / (1 + np.exp(-np.clip(x @ model.value[2], -30, 30)))
            else:
                scores = np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
