"""Toxicity: a weighted finite-state grammar over clauses.

A clause is read as a sequence of symbols: INSULT, THREAT, TARGET (a person or group),
NEGATION, REPORT (a verb of saying), or OTHER. Four transducers are composed into one
deterministic table:

* negation    marks insults and threats within three words after a negation,
* reporting   marks those after a verb of saying, to the end of the clause,
* targeting   marks those whose clause has named a target, and threats that find one,
* scoring     turns the marked symbols into factors.

A clause's score is the sum of factor times word weight over its marked words, and a
document's evidence is the sum over its matched clauses; isolated words of other
classes score nothing. Texts without an insult or threat are passed over by one
multi-pattern search.

The word weights are learned: from labelled rows outside fold 0 (a bounded sample, see
``labelled.MOST``) words and word beginnings are taken that cover the toxic texts and
occur in next to no clean one; the public seed words keep a prior weight. A logistic
curve over the evidence, fitted on the same rows, gives the score.

Defined results: a null or empty text has no evidence and gets the curve's lowest
score; without labelled rows of both kinds the seeds and a fixed curve are used; rows
that repeat are scored alike; an empty table gives an empty result; only the named
columns are read, so extra columns cannot clash; key, language and source are no inputs.
"""
from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled
from .common import byte_hashes, fold, mix64, quoted, text_blocks
from .words import shingle_sets

# Seed words of each class, lower case.
INSULT = ("idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting imbecile "
          "dumb dimwit filth vermin parasite scumbag bastard subhuman degenerate "
          "dummkopf abschaum trottel imbécile ordure abruti basura escoria imbécil").split()
THREAT = "kill murder stab strangle lynch destroy slaughter umbringen töten tuer égorger matar degollar".split()
TARGET = ("you your yours yourself they them their those people he she him her everyone "
          "du dich dir dein ihr euch sie tu toi vous ils elles tú usted ustedes ellos ellas").split()
NEGATION = "not no never none neither nor without hardly cannot isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás sin".split()
REPORT = ("said says say wrote writes claimed claims called calls quoted quotes shouted according "
          "sagte schrieb nannte dit écrit appelé dijo escribió llamó").split()

WORDS = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
ENDS = re.compile(r"[.!?;:\n]")
#: How much more often (by rate) a learned word must occur in toxic than in clean texts.
RATIO = 8
#: In how many distinct toxic texts a learned word must occur, whatever the size of the sample,
#: and how likely a word that is as frequent in both kinds may at most split so by chance.
TEXTS, CHANCE = 4, 1e-5
#: Toxic texts are copies from this Jaccard similarity of their five-word shingles on. It is
#: taken from the smallest hashes, for texts that share many of their min-hashes.
COPY, SKETCH, MARKS, MARKS_ALIKE = 0.8, 256, 64, 36
SYMBOLS = ("INSULT", "THREAT", "TARGET", "NEGATION", "REPORT", "OTHER")
MARKED = ("INSULT", "THREAT")


@dataclass
class Transducer:
    """Deterministic, with outputs on the arcs: step(state, symbol) -> (state, symbol)."""
    start: object
    step: object


def negation() -> Transducer:
    def step(left, symbol):
        if symbol == "NEGATION":
            return 3, symbol
        return max(left - 1, 0), symbol + "-" if left and symbol in MARKED else symbol
    return Transducer(0, step)


def reporting() -> Transducer:
    def step(open_, symbol):
        if symbol == "REPORT":
            return True, symbol
        return open_, symbol + "~" if open_ and symbol.startswith(MARKED) else symbol
    return Transducer(False, step)


def targeting() -> Transducer:
    """States: nothing yet, a target named, a threat still without target."""
    def step(state, symbol):
        if symbol == "TARGET":
            return "named", "MEETS" if state == "threat" else symbol
        if symbol.startswith(MARKED):
            named = "threat" if state == "open" and symbol.startswith("THREAT") else state
            return named, symbol + "@" if state == "named" else symbol
        return state, symbol
    return Transducer("open", step)


def factor(symbol: str) -> float:
    """Weight of a marked symbol: a threat counts when it has a target."""
    if symbol == "MEETS":
        return 1.0
    if not symbol.startswith(MARKED):
        return 0.0
    value = 0.1 if symbol.startswith("THREAT") else 1.0
    value *= 1.5 if "@" in symbol else 1.0
    value *= 10.0 if "@" in symbol and symbol.startswith("THREAT") else 1.0
    return value * (0.4 if "-" in symbol else 1.0) * (0.6 if "~" in symbol else 1.0)


def compose(parts: list[Transducer]) -> tuple[int, dict[tuple[int, str], tuple[int, float]]]:
    """One table (state, symbol) -> (state, factor) for the chain, each transducer
    reading what the one before it writes. Reachable states only."""
    start = tuple(p.start for p in parts)
    number, todo, table = {start: 0}, [start], {}
    while todo:
        state = todo.pop()
        for symbol in SYMBOLS:
            out, after = symbol, []
            for part, s in zip(parts, state):
                s, out = part.step(s, out)
                after.append(s)
            after = tuple(after)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            table[number[state], symbol] = (number[after], factor(out))
    return 0, table


@dataclass
class Grammar:
    """Words and word beginnings (ending in *) with class and weight, and the curve."""
    lexicon: dict[str, tuple[str, float]]
    curve: tuple[float, float, float] = (-3.0, 2.0, 1.0)
    start: int = 0
    table: dict = field(default_factory=dict)

    def __post_init__(self):
        self.start, self.table = compose([negation(), reporting(), targeting()])
        self.stems = sorted({len(w) - 1 for w in self.lexicon if w.endswith("*")}, reverse=True)
        self._search = None

    def __getstate__(self):
        return {**self.__dict__, "_search": None}

    def read(self, word: str) -> tuple[str, float]:
        hit = self.lexicon.get(word)
        if hit is None:
            for n in self.stems:
                hit = self.lexicon.get(word[:n] + "*") if len(word) >= n else None
                if hit:
                    return hit
        return hit or ("OTHER", 0.0)

    def clause(self, words: list[str]) -> float:
        state, score, threat = self.start, 0.0, 0.0
        for word in words:
            symbol, weight = self.read(word)
            state, times = self.table[state, symbol]
            if symbol == "THREAT":
                threat = max(threat, weight)
            score += times * (weight if symbol in MARKED else threat)
        return score

    def hits(self, text: str) -> list[int]:
        """Places of the words that can be an insult or threat."""
        if self._search is None:
            import ahocorasick
            self._search = ahocorasick.Automaton()
            for word, (kind, _) in self.lexicon.items():
                if kind in MARKED:
                    self._search.add_word(word.rstrip("*"), len(word.rstrip("*")))
            self._search.make_automaton()
        return [end - n + 1 for end, n in self._search.iter(text)] if len(self._search) else []

    def evidence(self, text: str) -> float:
        low = text.lower()
        total, done = 0.0, -1
        for at in sorted(set(self.hits(low))):
            if at < done or (at and (low[at - 1].isalnum())):
                continue  # in a clause already scored, or inside a word
            a = at
            while a > 0 and low[a - 1] not in ".!?;:\n":
                a -= 1
            end = ENDS.search(low, at)
            done = end.start() if end else len(low)
            total += self.clause(WORDS.findall(low, a, done))
        return total

    def inputs(self, text: str) -> tuple[float, float]:
        """Evidence, and evidence for each thousand characters, both on a log scale."""
        found = self.evidence(text)
        return math.log1p(found), math.log1p(1000 * found / max(len(text), 100))

    def score(self, text: str) -> float:
        a, b = self.inputs(text)
        x = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1 / (1 + math.exp(-max(min(x, 30.0), -30.0)))


def seeds() -> dict[str, tuple[str, float]]:
    out = {}
    for kind, words, weight in (("REPORT", REPORT, 0.0), ("NEGATION", NEGATION, 0.0), ("TARGET", TARGET, 0.0),
                                ("THREAT", THREAT, 1.0), ("INSULT", INSULT, 1.0)):
        out.update({w: (kind, weight) for w in words})
    return out


def features(text: str) -> set[str]:
    """Distinct words of three letters or more, and their beginnings of four to eight."""
    found = {w for w in WORDS.findall(text.lower()) if len(w) > 2}
    return found | {w[:n] + "*" for w in found for n in range(4, 9) if len(w) > n}


def sketches(texts: list[str]) -> Iterator[np.ndarray]:
    """The SKETCH smallest hashes of each text's shingles, sorted: all of a short text's."""
    for _, body, offsets in text_blocks([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])], "text"):
        for shingles in shingle_sets(body, offsets):
            yield shingles[:SKETCH].copy()


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two texts' shingles: exact if both sketches are whole."""
    union = np.union1d(a, b)
    if max(len(a), len(b)) == SKETCH:
        union = union[:SKETCH]
    return float((np.isin(union, a) & np.isin(union, b)).mean()) if len(union) else 1.0


def apart(found: list[np.ndarray]) -> list[int]:
    """Indices of the sketches that are no near copy of one kept before: copies have
    MARKS_ALIKE of MARKS min-hashes in common and a Jaccard similarity of COPY."""
    seeds_ = byte_hashes(11)[:MARKS]
    marks = np.zeros((len(found), MARKS), np.uint16)
    kept: list[int] = []
    for i, shingles in enumerate(found):
        if len(shingles):
            marks[len(kept)] = mix64(shingles[:, None] * seeds_).min(0).astype(np.uint16)
        else:
            marks[len(kept)] = 0
        common = (marks[:len(kept)] == marks[len(kept)]).sum(1)
        if not any(resemblance(found[kept[j]], shingles) >= COPY for j in np.flatnonzero(common >= MARKS_ALIKE)):
            kept.append(i)
    return kept


def learn(rows: DataFrame, candidates: int = 20_000, need: int = 4) -> Grammar:
    """Grammar from (label, text, weight) rows. Counts are made on the executors; the driver
    sees at most ``candidates`` features, their places in the bounded sample, and the
    sketches of its toxic texts, of which copies count once."""
    def sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"mark": pdf["mark"], "sketch": [s.tobytes() for s in sketches(pdf["text"].to_list())]})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (Counter(), Counter())
            for label, text, mark in zip(*(c.to_pylist() for c in batch.columns)):
                if not label or mark in distinct:
                    both[label].update(features(text))
            for label, counts in enumerate(both):
                n = pa.array(counts.values(), pa.int64())
                none = pa.array(np.zeros(len(counts), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), n if label else none, none if label else n],
                                                 names=["feature", "toxic", "clean"])

    totals = dict(rows.groupBy("label").count().collect())
    lexicon = seeds()
    clean = totals.get(0, 0)
    if not totals.get(1, 0) or not clean:
        return Grammar(lexicon)
    marked = rows.select("label", "text", F.md5(F.col("text").cast("binary")).alias("mark"))
    ones = marked.where("label = 1").dropDuplicates(["mark"])  # exact copies count once
    seen = sorted(ones.mapInPandas(sketched, "mark string, sketch binary").collect())
    distinct = {seen[i]["mark"] for i in apart([np.frombuffer(bytes(r["sketch"]), np.uint64) for r in seen])}
    toxic = len(distinct)
    odds = lambda t, c: math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
    n, t, c = F.col("toxic") + F.col("clean"), F.col("toxic"), F.col("clean")
    # Chernoff's bound of the binomial tail, as an exponent
    surprise = t * F.log(t / n * ((toxic + clean) / toxic)) + F.when(c > 0, c * F.log(c / n * ((toxic + clean) / clean))).otherwise(0.0)
    found = (marked.where("label = 0").unionByName(ones).mapInArrow(counted, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where((F.col("toxic") >= TEXTS) & (F.col("clean") * toxic * RATIO <= F.col("toxic") * clean) & (surprise >= -math.log(CHANCE)))
             .orderBy(F.col("toxic").desc(), "feature").limit(candidates).collect())
    weight = {r["feature"]: odds(r["toxic"], r["clean"]) for r in found}
    names = sorted(weight)
    index = {f: i for i, f in enumerate(names)}

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf[pdf["mark"].isin(distinct)]
            yield pd.DataFrame({"mark": pdf["mark"], "has": [sorted(index[f] for f in features(t) if f in index) for t in pdf["text"]]})

    texts = ones.mapInPandas(placed, "mark string, has array<int>").collect()
    sets = [np.array(r["has"], np.int64) for r in sorted(texts, key=lambda r: r["mark"])]
    # greedy cover: every toxic text should hold `need` chosen words, most shared words first
    missing = np.full(len(sets), need)
    gain = np.bincount(np.concatenate(sets) if sets else np.zeros(0, np.int64), minlength=len(names))
    covers = gain.copy()
    length = np.array([len(f) for f in names])
    shut = np.zeros(len(names), bool)
    holders: list[list[int]] = [[] for _ in names]
    for i, held in enumerate(sets):
        for f in held:
            holders[f].append(i)
    while len(names) and gain.max() > 0:
        close = np.flatnonzero(gain >= 0.95 * gain.max())
        best = int(close[np.argmax(length[close])])  # of about equals the longest
        word = names[best].rstrip("*")
        lexicon[names[best]] = ("INSULT", min(weight[names[best]] / 4, 2.0))
        for i in holders[best]:
            if missing[i]:
                missing[i] -= 1
                if not missing[i]:
                    np.subtract.at(gain, sets[i][~shut[sets[i]]], 1)
        # longer words with the chosen beginning, and beginnings that say no more than it
        if names[best].endswith("*"):
            shut[bisect_left(names, word):bisect_left(names, word + chr(0x10FFFF))] = True
        for j in (index.get(word[:n] + "*") for n in range(4, 9)):
            if j is not None and covers[j] <= 1.2 * covers[best]:
                shut[j] = True
        shut[best] = True
        gain[shut] = 0
    grammar = Grammar(lexicon)

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"label": pdf["label"], "weight": pdf["weight"], "x": [list(grammar.inputs(t)) for t in pdf["text"]]})

    seen = rows.mapInPandas(measured, "label int, weight double, x array<double>").collect()  # four numbers for each row of the sample
    grammar.curve = curve(np.array([r["label"] for r in seen], float), np.array([[1.0, *r["x"]] for r in seen]),
                          np.array([r["weight"] for r in seen]))
    return grammar


def curve(y: np.ndarray, design: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Intercept and slopes of a logistic curve over weighted rows, by damped Newton steps."""
    share = weight / weight.sum()
    w = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (share * (y - p)) - ridge * w
        bend = (design * (share * p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, grammar: Grammar, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and score of every row."""
    slim = docs.select(quoted(key).alias("key"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"key": pdf["key"], "score": [grammar.score(t) for t in pdf["text"]]})

    return slim.mapInPandas(run, f"key {slim.schema['key'].dataType.simpleString()}, score double")


def clean(docs: DataFrame, grammar: Grammar, *, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents whose score is below ``limit``, with all their columns."""
    @F.pandas_udf("boolean")
    def below(texts: pd.Series) -> pd.Series:
        return pd.Series([grammar.score(t) < limit for t in texts], dtype=bool)

    return docs.where(below(F.coalesce(quoted(text).cast("string"), F.lit(""))))


def fitted(docs: DataFrame, labels: DataFrame) -> Grammar:
    return learn(labelled.sample(docs, labels, "toxic", tag="toxicity-sample"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fitted(docs, labels)).select(
        F.col("key").alias("doc_id"), (fold("key") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
