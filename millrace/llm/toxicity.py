"""Toxicity by a weighted finite-state grammar over clauses.

The grammar composes small weighted transducers over the classes of a clause's words (insult, threat,
target, negation, reported speech, other): each rewrites a class and multiplies the weight of what it
lets through. Negation weakens the insults in its scope, reported speech what follows it, a target in
the clause strengthens insults and is needed for a threat to count in full. The composed machine runs
over every clause that holds an insult or threat; the sums of matched clauses, not single words, are a
text's evidence, and a logistic curve turns the evidence into a score.

What counts as an insult is learned: beginnings of words (4 to 8 letters), whole longer words and whole words of
up to 3 letters that occur in at least `LEAST_TEXTS` toxic training texts and whose share among these is far above
that among the others: the log of the ratio, less `SURE` standard errors, must lie above zero, a bar that does not
move with the size of the table. They are weighted by that log, besides a short
list of known ones. The fit takes at most about `sample_rows` labelled texts, chosen by a hash of the
id, so its cost is bounded and its small tables may go to the driver; the curve is fitted on evidence
from words learned on the other half of the sample, so that it does not trust what was learned by
heart. Scoring reads every text whole; an Aho-Corasick automaton finds the beginnings, and only
clauses with a hit are cut into words.

Defined results: a null text counts as the empty one; a text without evidence gets the curve's value at
zero; labels that are null, or whose id is null, and ids with labels of both kinds are not learned from; of
several texts with a labelled id one is; with fewer than two labels of either class the listed words and a fixed curve are used; repeated
rows get a row each; an empty table gives no rows; other columns are never read.
"""

import math
import re
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millrace.llm.common import labelled_sample, whole_text
from millrace.session import cut_lineage

SAMPLE_ROWS = 20_000
SHORTEST, LONGEST = 4, 8
LEAST_TEXTS, LEAST_WEIGHT, SURE = 5, 2.0, 3.0
KNOWN_WEIGHT, THREAT_WEIGHT, TARGET_WEIGHT = 3.0, 1.5, 0.5

# fixed values: words of the grammar's closed classes
INSULTS = "idiot moron stupid scum loser trash worthless pathetic disgusting clown dumb imbecile bastard".split()
THREATS = "kill hurt destroy shoot stab murder strangle slaughter töten umbringen tuer frapper matar".split()
TARGETS = "you your yours yourself yourselves ya dich euch vous toi usted ustedes".split()
NEGATIONS = "not never no isn aren wasn weren don doesn didn nicht kein keine niemals ne pas jamais nunca".split()
REPORTS = "said says told called calls quoted reported wrote claimed sagte sagt dit dijo".split()

CLASSES = ("insult", "threat", "target", "negation", "report", "other")
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n]")


class Transducer:
    """arcs: (state, class) to (next state, class given out, factor). Missing arcs give the class out
    unchanged with factor 1 and lead to `idle[state]`, or stay."""

    def __init__(self, start, arcs, idle=None):
        self.start, self.arcs, self.idle = start, arcs, idle or {}

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (self.idle.get(state, state), symbol, 1.0))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds what `first` gives out to `second`; factors multiply."""
    start = (first.start, second.start)
    arcs, open_, met = {}, [start], {start}
    while open_:
        state = open_.pop()
        for symbol in CLASSES:
            after, between, a = first.step(state[0], symbol)
            then, out, b = second.step(state[1], between)
            arcs[state, symbol] = ((after, then), out, a * b)
            if (after, then) not in met:
                met.add((after, then))
                open_.append((after, then))
    return Transducer(start, arcs)


def grammar() -> Transducer:
    """Insult and threat recognition, target, negation and reported speech, composed."""
    scope = 3
    negation = Transducer(0, {
        **{(left, "negation"): (scope, "negation", 1.0) for left in range(scope + 1)},
        **{(left, hit): (left - 1, hit, 0.25) for left, hit in product(range(1, scope + 1), ("insult", "threat"))},
    }, idle={left: left - 1 for left in range(1, scope + 1)})
    reported = Transducer("direct", {
        ("direct", "report"): ("reported", "report", 1.0),
        **{("reported", hit): ("reported", hit, 0.5) for hit in ("insult", "threat")}})
    insult = Transducer("none", {
        ("none", "insult"): ("insulted", "insult", 1.0),
        ("none", "target"): ("none", "target", 0.0)})  # a target counts by itself only after an insult
    target = Transducer("none", {
        ("none", "target"): ("aimed", "target", 1.0),
        ("aimed", "insult"): ("aimed", "insult", 1.5)})
    threat = Transducer("none", {
        ("none", "threat"): ("threatened", "other", 0.0),  # a threat without a target before is held back ...
        ("none", "target"): ("aimed", "target", 1.0),
        ("aimed", "threat"): ("aimed", "threat", 1.0),
        ("threatened", "target"): ("aimed", "threat", THREAT_WEIGHT / TARGET_WEIGHT)})  # ... until one follows
    whole = negation
    for part in (reported, threat, insult, target):
        whole = compose(whole, part)
    return whole


def clause_weight(machine: Transducer, symbols) -> float:
    """The weight of one clause given as (class, weight of the word)."""
    state, total = machine.start, 0.0
    for symbol, weight in symbols:
        state, _, factor = machine.step(state, symbol)
        total += weight * factor
    return total


class Evidence:
    """Evidence of texts under a lexicon of word beginnings with weights."""

    FEATURES = ("total", "strongest", "clauses", "density")

    def __init__(self, lexicon: dict):
        import ahocorasick

        self.machine = grammar()
        self.closed = {**{w: ("report", 0.0) for w in REPORTS}, **{w: ("negation", 0.0) for w in NEGATIONS},
                       **{w: ("target", TARGET_WEIGHT) for w in TARGETS}, **{w: ("threat", THREAT_WEIGHT) for w in THREATS}}
        self.stems = ahocorasick.Automaton()
        for stem, weight in lexicon.items():
            # squared, so that many weak beginnings in a long text do not add up to a few strong ones
            self.stems.add_word(stem, (len(stem), weight * weight / KNOWN_WEIGHT, len(stem) < SHORTEST))
        for word in THREATS:
            if word not in lexicon:
                self.stems.add_word(word, (len(word), 0.0, False))  # marks the clause; the class gives the weight
        self.stems.make_automaton()

    def hits(self, text):
        """Weight of the heaviest beginning that starts at each hit word's first letter."""
        found = {}
        for last, (length, weight, whole) in self.stems.iter(text):
            at = last - length + 1
            if whole and text[last + 1:last + 2].isalpha():  # short words are no beginnings
                continue
            if (at == 0 or not text[at - 1].isalpha()) and weight >= found.get(at, 0.0):
                found[at] = weight
        return found

    def clauses(self, text):
        """(start, end) and hits of every clause that has a hit."""
        found, end, held, start = self.hits(text), -1, {}, 0
        for at in sorted(found):
            if at >= end:
                if held:
                    yield start, end, held
                held = {}
                start = max(text.rfind(c, end if end > 0 else 0, at) for c in ".!?;:\n") + 1
                start = max(start, end, 0)
                after = _CLAUSE_END.search(text, at)
                end = after.start() if after else len(text)
            held[at] = found[at]
        if held:
            yield start, end, held

    def of(self, text: str):
        text = text.lower()
        total = strongest = 0.0
        matched = 0
        for start, end, hits in self.clauses(text):
            symbols = []
            for word in _WORD.finditer(text, start, end):
                known = self.closed.get(word[0])
                if known and known[0] == "threat":
                    symbols.append(known)
                elif hits.get(word.start(), 0.0) > 0:
                    symbols.append(("insult", hits[word.start()]))
                else:
                    symbols.append(known or ("other", 0.0))
            weight = clause_weight(self.machine, symbols)
            if weight > 0:
                matched += 1
                total += weight
                strongest = max(strongest, weight)
        return tuple(math.log1p(x) for x in (total, strongest, matched, total * 100 / (len(text) / 6 + 20)))

    def table(self, texts):
        return np.array([self.of(text) for text in texts], dtype=np.float64).reshape(-1, len(self.FEATURES))


def beginnings(text: str) -> set:
    """Beginnings of SHORTEST to LONGEST letters of a text's words, and the words that are shorter or longer."""
    out = set()
    for word in set(_WORD.findall(text.lower())):
        out.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
        if not SHORTEST <= len(word) <= LONGEST:
            out.add(word)
    return out


def weigh(counts: pd.DataFrame, toxic: float, clean: float) -> dict:
    """Lexicon from (stem, t, c): texts of either class that hold the stem. A longer stem is kept only
    where it weighs more than the shorter one it extends."""
    lexicon = {word: KNOWN_WEIGHT for word in INSULTS}
    enough = counts[counts["t"] >= LEAST_TEXTS]
    t, c = enough["t"] + 0.5, enough["c"] + 0.5
    weights = np.log(t / (toxic + 1)) - np.log(c / (clean + 1))
    error = np.sqrt(np.maximum(1 / t - 1 / (toxic + 1), 0) + np.maximum(1 / c - 1 / (clean + 1), 0))
    learned = {s: float(w) for s, w, e in zip(enough["stem"], weights, error) if w >= LEAST_WEIGHT and w > SURE * e}
    for stem in sorted(learned, key=lambda s: (len(s), s)):
        shorter = max((lexicon.get(stem[:n], 0.0) for n in range(SHORTEST, len(stem))), default=0.0)
        if learned[stem] > shorter + 0.1:
            lexicon[stem] = learned[stem]
    return lexicon


def rising(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic coefficients, none below zero: more evidence never lowers a score. The feature with the
    lowest coefficient is left out until all of the others rise."""
    used = list(range(x.shape[1]))
    while True:
        w = logistic(x[:, used], y)
        if not used or w[:-1].min() >= 0:
            out = np.zeros(x.shape[1] + 1)
            out[used], out[-1] = w[:-1], w[-1]
            return out
        used.pop(int(np.argmin(w[:-1])))


def logistic(x: np.ndarray, y: np.ndarray, ridge=1.0, rounds=50) -> np.ndarray:
    """Coefficients, the constant last, by Newton steps with a small ridge on all but the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class ToxicityModel:
    """A lexicon and a curve."""

    FALLBACK = np.array([3.0, 0.0, 0.0, 0.0, -3.0])

    def __init__(self, lexicon=None, curve=None):
        self.lexicon = lexicon or {word: KNOWN_WEIGHT for word in INSULTS}
        self.curve = self.FALLBACK if curve is None else curve

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS, id_col="doc_id", text_col="text",
            label_col="toxic", seed=11) -> "ToxicityModel":
        """Learn from the texts of `docs` that `labels` (id, 0 or 1) names."""
        sample = cut_lineage(labelled_sample(docs, labels, sample_rows, id_col, text_col, label_col, seed, 2)
                             .withColumnRenamed("part", "half"), "toxic-sample")
        sizes = {(r["label"], r["half"]): r["count"] for r in sample.groupBy("label", "half").count().collect()}
        toxic, clean = ([sizes.get((label, half), 0) for half in (0, 1)] for label in (1, 0))
        if min(*toxic, *clean) < 1:
            return cls()
        def counted(wanted):
            def count(batches):
                met = Counter()
                for batch in batches:
                    for text, label, half in zip(batch["text"], batch["label"], batch["half"]):
                        stems = beginnings(text)
                        met.update((s, label, half) for s in (stems if wanted is None else stems & wanted))
                yield pd.DataFrame([(*key, n) for key, n in met.items()], columns=["stem", "label", "half", "n"])
            return count

        shape = "stem string, label int, half int, n bigint"
        by_stem = sample.filter("label = 1").mapInPandas(counted(None), shape).groupBy("stem").agg(
            F.sum(F.when(F.col("half") == 0, F.col("n"))).alias("t0"),
            F.sum(F.when(F.col("half") == 1, F.col("n"))).alias("t1")).na.fill(0)
        stems = by_stem.filter(F.col("t0") + F.col("t1") >= LEAST_TEXTS).toPandas()
        clean_counts = sample.filter("label = 0").mapInPandas(counted(set(stems["stem"])), shape).groupBy("stem").agg(
            F.sum(F.when(F.col("half") == 0, F.col("n"))).alias("c0"),
            F.sum(F.when(F.col("half") == 1, F.col("n"))).alias("c1")).na.fill(0).toPandas()
        counts = stems.merge(clean_counts, "left", "stem").fillna(0)

        def lexicon(halves):
            some = pd.DataFrame({"stem": counts["stem"], "t": sum(counts[f"t{h}"] for h in halves),
                                 "c": sum(counts[f"c{h}"] for h in halves)})
            return weigh(some, sum(toxic[h] for h in halves), sum(clean[h] for h in halves))

        crossed = {0: lexicon([1]), 1: lexicon([0])}

        def measured(batches):
            evidence = {half: Evidence(words) for half, words in crossed.items()}
            for batch in batches:
                rows = [(int(label), *evidence[half].of(text))
                        for text, label, half in zip(batch["text"], batch["label"], batch["half"])]
                yield pd.DataFrame(rows, columns=["label", *Evidence.FEATURES])

        fields = "label int, " + ", ".join(f"{name} double" for name in Evidence.FEATURES)
        table = sample.mapInPandas(measured, fields).toPandas()
        table = table.sort_values(list(table.columns))  # one order, so that sums agree between runs
        curve = rising(table[list(Evidence.FEATURES)].to_numpy(), table["label"].to_numpy(dtype=np.float64))
        return cls(lexicon([0, 1]), curve)

    def scores(self, evidence: Evidence, texts) -> np.ndarray:
        x = evidence.table(texts)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve[:-1] + self.curve[-1], -30, 30)))

    def score(self, text_col) -> Column:
        """0 to 1, higher for texts more likely toxic."""
        model, kept = self, {}

        @F.pandas_udf(DoubleType())
        def scored(texts: pd.Series) -> pd.Series:
            if "evidence" not in kept:
                kept["evidence"] = Evidence(model.lexicon)
            return pd.Series(model.scores(kept["evidence"], texts), dtype="float64")

        return scored(whole_text(text_col))


def reject(docs: DataFrame, model: ToxicityModel, threshold=0.7, text_col="text") -> DataFrame:
    """The rows of `docs` that score below the threshold, with all their columns."""
    scored = docs.select(F.struct("*").alias("row"), model.score(text_col).alias("score"))
    return scored.filter(F.col("score") < threshold).select("row.*")
