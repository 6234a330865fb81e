"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become classes (insult, threat, intent, target, negation, report, other) by a lexicon. Five
weighted transducers read a clause's classes: the insult and the threat machine turn words of abuse into
marked symbols, and one each marks abuse that a negation, a report or a target reaches. Each arc has a factor;
the composition is one table of (state, class) -> (state, mark, product of the factors), run once over a clause that
holds any abuse. A clause scores by the sum, along its path, of factor times lexicon weight; a
document by a logistic model over its clauses' scores, marks and heaviest words.

The lexicon's weights are log odds learned from labelled rows, for words and for word
beginnings, so that invented or inflected insults of any language are found. The word lists below
only say what has a class without any label.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.worker import releasing

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Marks of a word of abuse: plain, then + 1 negated, + 2 reported, + 4 targeted.
MARKS = 8
#: Symbols from here on are marked abuse: 6 + marks for insults, 6 + 8 + marks for threats; then comes intent.
ABUSE = 6
INTENT = ABUSE + 2 * MARKS
SYMBOLS = INTENT + 1
#: Words whose class needs no label; general vocabulary of the four languages.
WORDS = {
    INSULT: "idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown fool vermin "
            "imbécile débile crétin connard idiote minable dumm trottel abschaum widerlich wertlos "
            "estúpido imbécil basura asqueroso inútil",
    THREAT: "kill hurt destroy beat stab shoot die tuer frapper détruire mourir töten schlagen "
            "vernichten sterben matar golpear destruir morir",
    TARGET: "you your yours they them he she him her these those tu toi vous ton ta tes votre ils elles "
            "du dich dir dein ihr euch sie tú ti usted ustedes vosotros tus ellos ellas",
    NEGATION: "not no never neither nor without isn aren wasn don doesn didn pas jamais ni sans nicht "
              "kein keine nie ohne nunca ni sin",
    REPORT: "said says say wrote writes told tells quoted reported called according dit écrit raconte "
            "sagte sagt schrieb berichtet dijo dice escribió",
    INTENT: "will ll gonna going shall must vais vas va allons allez vont werde wirst wird werden voy vamos van",
}
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:|\n\"“”«»]")
CLAUSE_ENDS, QUOTES = frozenset(".!?;:|\n"), frozenset("\"“”«»")
#: Words that a negation, a target, a report and an intent reach.
REACH = {NEGATION: 3, TARGET: 4, REPORT: 12, INTENT: 4}
#: Factors of a word of abuse that one of these reaches.
FACTORS = {NEGATION: 0.25, TARGET: 1.5, REPORT: 0.5, INTENT: 1.5}
#: Factors of an insult right after another and of a threat without intent.
PILED, IDLE = 1.25, 0.75
#: Beginnings of words that may carry a weight.
PREFIXES = (4, 5, 6)
LEXICON_SIZE = 4096
TRAINING_ROWS = 20_000
#: Tokens whose reading a task keeps, some 300 bytes each.
REMEMBERED = 50_000
FEATURES = 2 * MARKS + 7


@dataclass
class Transducer:
    """A deterministic weighted transducer.

    table[state][symbol] is (next state, output symbol), factors[state][symbol] what the arc multiplies a word's weight by.
    """

    table: list[list[tuple[int, int]]]
    factors: list[list[float]]

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes; factors of both arcs are multiplied."""
        width = len(other.table)
        pairs = [(a, b) for a in range(len(self.table)) for b in range(width)]
        return Transducer(
            [[(to * width + other.table[b][out][0], other.table[b][out][1]) for to, out in self.table[a]] for a, b in pairs],
            [
                [f * other.factors[b][out] for f, (_, out) in zip(self.factors[a], self.table[a], strict=True)]
                for a, b in pairs
            ],
        )

    def clause(self, words: list[tuple[int, float]]) -> tuple[list[int], float, float]:
        """Marks of the words of abuse in a clause of (class, weight), its score and its heaviest lexicon weight.

        A word of abuse without a lexicon weight counts 1.
        """
        state, marks, score, heaviest = 0, [], 0.0, 0.0
        for kind, weight in words:
            factor = self.factors[state][kind]
            state, symbol = self.table[state][kind]
            if ABUSE <= symbol < INTENT:
                marks.append(symbol - ABUSE)
                weight = weight if weight > 0 else 1.0
                score, heaviest = score + factor * weight, max(heaviest, weight)
        return marks, score, heaviest


def machine(n_states: int, step: Callable[[int, int], tuple[int, int, float]]) -> Transducer:
    """The transducer of a rule (state, symbol) -> (next state, output symbol, factor)."""
    arcs = [[step(s, x) for x in range(SYMBOLS)] for s in range(n_states)]
    return Transducer([[x[:2] for x in row] for row in arcs], [[x[2] for x in row] for row in arcs])


def insults() -> Transducer:
    """Marks insults; one right after another weighs more."""
    return machine(2, lambda s, x: (1, ABUSE, PILED if s else 1.0) if x == INSULT else (0, x, 1.0))


def threats() -> Transducer:
    """Marks threats; one that an intent reaches weighs more, any other less."""
    def step(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == THREAT:
            return max(state - 1, 0), ABUSE + MARKS, FACTORS[INTENT] if state else IDLE
        return (REACH[INTENT] if symbol == INTENT else max(state - 1, 0)), symbol, 1.0

    return machine(REACH[INTENT] + 1, step)


def reaching(trigger: int, mark: int) -> Transducer:
    """Adds ``mark`` and the trigger's factor to words of abuse that it reaches."""
    def step(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol == trigger:
            return REACH[trigger], symbol, 1.0
        if state and ABUSE <= symbol < INTENT:
            return state - 1, ABUSE + (symbol - ABUSE | mark), FACTORS[trigger]
        return max(state - 1, 0), symbol, 1.0

    return machine(REACH[trigger] + 1, step)


def grammar() -> Transducer:
    return insults().then(threats()).then(reaching(NEGATION, 1)).then(reaching(REPORT, 2)).then(reaching(TARGET, 4))


@dataclass
class Lexicon:
    """Weights of words and of word beginnings (``abcd*``) that speak for abuse."""

    weights: dict[str, float]
    classes: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.classes = {w: c for c, words in WORDS.items() for w in words.split()}
        self.prefixes = {n: {k[:-1]: w for k, w in self.weights.items() if k[-1] == "*" and len(k) == n + 1}
                         for n in PREFIXES}

    def read(self, word: str) -> tuple[int, float]:
        """Class and weight of a word."""
        kind = self.classes.get(word, OTHER)
        weight = self.weights.get(word, 0.0)
        for n, known in self.prefixes.items():
            if len(word) >= n:
                weight = max(weight, known.get(word[:n], 0.0))
        if weight > 0 and kind in (OTHER, INSULT):
            return INSULT, weight
        return kind, weight


def features(text: str, lexicon: Lexicon, machine: Transducer, memo: dict[str, tuple[int, float]]) -> np.ndarray:
    """What the grammar finds in a text; clauses without abuse only count as length."""
    found = np.zeros(FEATURES)
    clauses = hits = words = 0
    best = second = heaviest = next_heaviest = total = 0.0
    clause: list[tuple[int, float]] = []
    abusive = quoted = False

    def end_clause() -> None:
        nonlocal hits, best, second, heaviest, next_heaviest, total
        marks, score, top = machine.clause(clause)
        for mark in marks:
            found[mark] += 1
        hits += 1
        total += score
        best, second = max(best, score), max(second, min(best, score))
        heaviest, next_heaviest = max(heaviest, top), max(next_heaviest, min(heaviest, top))

    for token in TOKEN.findall(text.lower()):
        if token in CLAUSE_ENDS:
            if abusive:
                end_clause()
            clauses += bool(clause)
            clause, abusive = [], False
        elif token in QUOTES:
            quoted = not quoted
            if quoted:
                clause.append((REPORT, 0.0))
        else:
            read = memo.get(token)
            if read is None:
                if len(memo) > REMEMBERED:
                    memo.clear()
                read = memo[token] = lexicon.read(token)
            clause.append(read)
            abusive = abusive or read[0] in (INSULT, THREAT)
            words += 1
    if abusive:
        end_clause()
    found[:2 * MARKS] = np.log1p(found[:2 * MARKS])
    found[2 * MARKS:] = (
        math.log1p(hits), math.log1p(total), heaviest, next_heaviest, 100 * hits / (10 + words),
        math.log1p(best), math.log1p(second),
    )
    return found


@dataclass
class Model:
    lexicon: Lexicon
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Every fifth id by its CRC-32 as text; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int, broadcast: bool = True) -> DataFrame:
    """text, toxic of at most ``most`` labelled rows that are not held out, the first by a hash of the id."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    texts = docs.select("doc_id", "text").where("text is not null")
    # Bounded by ``most`` rows of two numbers.
    return (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy(F.xxhash64("text").alias("copy"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )


def learn_lexicon(rows: DataFrame, size: int = LEXICON_SIZE) -> Lexicon:
    """Words and beginnings that at least 1 in 500 toxic texts hold, and far more of these than of others."""
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 2))
    beginnings = [
        F.array_distinct(F.transform(
            F.filter(words, lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))
        ))
        for n in PREFIXES
    ]
    n_toxic, n_clean = (x or 0 for x in rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first())
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    found = (
        rows.select("toxic", F.explode(F.concat(words, *beginnings)).alias("entry"))
        .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .where(F.col("toxic") >= max(3, n_toxic // 500)).withColumn("weight", odds).where("weight > 2.5")
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "entry").limit(size)
    )
    return Lexicon({r.entry: float(r.weight) for r in found.collect()})


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """Lexicon and logistic model from at most ``most`` labelled rows; without both labels all score alike.

    The driver gets the features of those rows, ``FEATURES`` numbers each.
    """
    rows = training_rows(docs, labels, most).persist()
    try:
        lexicon, machine = learn_lexicon(rows), grammar()

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo: dict[str, tuple[int, float]] = {}
            for b in batches:
                x = [features(t, lexicon, machine, memo).tolist() for t in b.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.list_(pa.float64())), b.column(1).cast(pa.int32())], names=["x", "y"]
                )

        data = rows.select("text", F.col("toxic").cast("int")).mapInArrow(releasing(measure), "x array<double>, y int").collect()
    finally:
        rows.unpersist()
    x = np.array([r.x for r in data]).reshape(-1, FEATURES)
    y = np.array([r.y for r in data], dtype=float)
    return fitted(x, y, lexicon)


def fitted(x: np.ndarray, y: np.ndarray, lexicon: Lexicon, ridge: float = 0.1) -> Model:
    """Newton's method on the regularised logistic loss."""
    mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = np.where((s := x.std(axis=0) if len(x) else np.ones(FEATURES)) > 1e-9, s, 1.0)
    beta = np.zeros(FEATURES + 1)
    if 0 < y.sum() < len(y):
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        penalty = np.diag([ridge] * FEATURES + [1e-6])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            grad = z.T @ (p - y) + penalty @ beta
            hess = (z * (p * (1 - p))[:, None]).T @ z + penalty
            step = np.linalg.solve(hess, grad)
            beta -= step
            if np.abs(step).max() < 1e-6:
                break
    else:
        beta[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    return Model(lexicon, mean, scale, beta[:-1], float(beta[-1]))


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and score (0 to 1) last; a score column of that name is replaced.

    Null and empty texts are scored as texts without words. Repeated rows score alike, an empty
    table gives no rows. The id is not read.
    """
    machine = grammar()

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict[str, tuple[int, float]] = {}
        for texts in batches:
            x = [features(t or "", model.lexicon, machine, memo) for t in texts.to_pylist()]
            yield pa.array(model.score(np.array(x).reshape(-1, FEATURES)), pa.float64())

    score = F.arrow_udf(releasing(scored), "double")
    return docs.withColumn("score", score(F.col(text_col)))


def judged(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5 on), one row per input row."""
    scored = toxicity_scores(docs.select("doc_id", "text"), fit(docs, labels, most))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """``docs`` without the rows predicted as toxic."""
    model, machine = fit(docs, labels, most), grammar()

    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict[str, tuple[int, float]] = {}
        for texts in batches:
            x = [features(t or "", model.lexicon, machine, memo) for t in texts.to_pylist()]
            yield pa.array(model.score(np.array(x).reshape(-1, FEATURES)) < 0.5)

    return docs.where(F.arrow_udf(releasing(clean), "boolean")(F.col("text")))
