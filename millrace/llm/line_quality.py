"""Document quality from a linear-chain conditional random field over lines.

Every line that is not blank is labelled good or bad. Its features are shape measures (length, words, capitals,
digits, punctuation, symbols, doubled marks, repeated words, repetition within the text, first and last sign ...),
cut into bins at quantiles. The line's own bins and those of the lines before and after give the state's weight;
the weight of a change of state depends on how alike the two lines' bins are. Forward-backward gives each
line's marginal of being good; their mean, weighted by line length, is the text's evidence, and a logistic
curve, fitted on texts that the field was not fitted on, turns it into a score.

* Learning: the labels name texts, not lines. A first fit lets every line take its text's label; then the lines
  of bad texts that the field holds for good become good (one of a text stays bad at least), and it is fitted
  again. It learns from about `sample_rows` labelled texts, drawn by a hash of the id, of each at most
  `WINDOWS` runs of `WINDOW` lines spread over the text; this bounds what the driver gets.
* Scoring reads every text whole, in its batch. Both passes are products of 2 x 2 matrices, taken by a
  segmented scan: the first line of a text has a matrix that forgets what came before, so texts of any
  number of lines are handled together in about log2(most lines) steps.

Defined results: a null text counts as the empty one; a text without lines counts as one empty line; blank
lines have no marginal (null); labels that are null, or whose id is null, and ids with labels of both kinds are not
learned from; of several texts with a labelled id one is; without both labels every score is 0.5;
repeated rows get a row each; an empty table gives no rows; other columns are never read.
"""

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millrace.llm.common import labelled_sample, whole_text
from millrace.llm.kneser_ney import batches_of
from millrace.llm.toxicity import rising
from millrace.session import cut_lineage

SAMPLE_ROWS = 6000
WINDOW, WINDOWS = 64, 2
BINS = 8
RIDGE, ROUNDS = 0.5, 100
KINDS = 4  # of pairs of neighbouring lines, by how alike they are

SPACE, LOWER, UPPER, DIGIT, POINT, CRY, BAR, QUOTE, SYMBOL, HIGH = range(10)
_CLASS = np.full(256, SYMBOL, dtype=np.int64)
_CLASS[128:] = HIGH
for _class, _signs in ((SPACE, b" \t\n\r\x0b\x0c"), (LOWER, bytes(range(97, 123))), (UPPER, bytes(range(65, 91))),
                       (DIGIT, b"0123456789"), (POINT, b".,;:"), (CRY, b"!?"), (BAR, b"|"), (QUOTE, b"'\"()[]-")):
    _CLASS[list(_signs)] = _class
FEATURES = ("bytes", "words", "word_length", "capitals", "digits", "points", "cries", "bars", "quotes", "symbols",
            "doubled", "capital_words", "high", "longest", "ending_marks", "repeated_words", "first", "last", "copies", "lines")


def lines_of(text: str) -> list:
    """The lines of a text that are not blank, at least one."""
    return [line for line in text.encode().split(b"\n") if line.strip()] or [b""]


def measure(texts) -> tuple[np.ndarray, np.ndarray]:
    """(a row of FEATURES per line, the number of lines of every text) of texts given as lists of lines."""
    flat = [line for lines in texts for line in lines]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join(flat) + b"\n", dtype=np.uint8)
    length = np.fromiter(map(len, flat), np.int64, len(flat))
    ends = np.cumsum(length + 1) - 1  # of each line's closing line end
    starts = ends - length
    kind = _CLASS[data]
    line = np.repeat(np.arange(len(flat)), length + 1)
    met = np.bincount(line * 10 + kind, minlength=10 * len(flat)).reshape(-1, 10)
    space = kind == SPACE
    opens = ~space & np.concatenate(([True], space[:-1]))
    closes = ~space & np.concatenate((space[1:], [True]))
    mark = (kind >= POINT) & (kind <= SYMBOL)
    doubled = mark & np.concatenate(([False], data[1:] == data[:-1]))

    def count(flags):
        return np.bincount(line[flags], minlength=len(flat))

    words = np.maximum(count(opens), 1)
    solid = np.maximum(length + 1 - met[:, SPACE], 1)
    letters = np.maximum(met[:, LOWER] + met[:, UPPER], 1)
    word_lengths = np.flatnonzero(closes) - np.flatnonzero(opens) + 1
    longest = np.zeros(len(flat), dtype=np.int64)
    np.maximum.at(longest, line[opens], word_lengths)
    distinct = np.fromiter((len(set(x.split())) for x in flat), np.int64, len(flat))
    copies = np.fromiter((n - 1 for lines in texts for c in [Counter(lines)] for n in map(c.__getitem__, lines)),
                         np.int64, len(flat))
    empty = length == 0
    columns = [
        np.log2(1 + length), np.log2(words), solid / words, met[:, UPPER] / letters, met[:, DIGIT] / solid,
        met[:, POINT] / words, met[:, CRY] / words, met[:, BAR] / words, met[:, QUOTE] / words, met[:, SYMBOL] / words,
        count(doubled) / words, count(opens & (kind == UPPER)) / words, met[:, HIGH] / solid, np.log2(1 + longest),
        count(closes & mark) / words, 1 - distinct / words, np.where(empty, SPACE, kind[starts]),
        np.where(empty, SPACE, kind[np.maximum(ends - 1, 0)]), np.minimum(copies, 3), np.log2(np.repeat(sizes, sizes))]
    return np.stack(columns, axis=1).astype(np.float32), sizes


class Bins:
    """Edges of every feature's bins, and the place of each bin in one vector of weights."""

    def __init__(self, table: np.ndarray, bins: int = BINS):
        shares = np.linspace(0, 1, bins)[1:-1]
        self.edges = []
        for x in table.T.astype(np.float64):  # the least value, often a plain zero, has a bin of its own
            least, above = x.min(), x[x > x.min()]
            cuts = np.quantile(above, shares) if len(above) else above
            self.edges.append(np.unique(np.append(cuts, np.nextafter(least, np.inf))))
        self.first = np.cumsum([0] + [len(e) + 1 for e in self.edges])

    @property
    def count(self) -> int:
        return int(self.first[-1])

    def places(self, table):
        """The place of each line's bin of every feature."""
        return np.stack([np.searchsorted(e, x, side="right") + at for e, x, at in zip(self.edges, table.T, self.first)], axis=1)


def _scan(matrices, most: int, backwards=False):
    """Products of each matrix with up to `most` neighbours before it (after it if `backwards`), scaled."""
    a, step = matrices.reshape(-1, 4).T.copy(), 1
    while step < most:
        (p, q, r, s), (t, u, v, w) = a[:, :-step], a[:, step:]
        product = np.stack((p * t + q * v, p * u + q * w, r * t + s * v, r * u + s * w))
        product /= product.sum(axis=0)
        a = np.concatenate((product, a[:, -step:]) if backwards else (a[:, :step], product), axis=1)
        step *= 2
    return a.T.reshape(-1, 2, 2)


class Field:
    """The weights of a linear-chain CRF: bins of the line, the one before and the one after; changes of state."""

    def __init__(self, bins: Bins, weights: np.ndarray | None = None):
        self.bins = bins
        self.shapes = (bins.count, bins.count, bins.count, 2, KINDS * 4)
        self.weights = np.zeros(sum(self.shapes)) if weights is None else weights

    def parts(self, weights):
        return np.split(weights, np.cumsum(self.shapes)[:-1])

    def lay_out(self, table, sizes):
        """What does not depend on the weights: bin places, neighbours, kinds of pairs."""
        places = self.bins.places(table)
        first = np.zeros(len(table), dtype=bool)
        first[np.cumsum(sizes) - sizes] = True
        last = np.append(first[1:], True)
        alike = np.zeros(len(table))
        alike[1:] = (places[1:] == places[:-1]).mean(axis=1)
        kinds = np.minimum((alike * KINDS).astype(np.int64), KINDS - 1)
        return places, first, last, kinds, int(sizes.max(initial=1))

    def run(self, laid, weights):
        """(marginal of good per line, marginals of pairs of states, log of the sum over all labellings)."""
        places, first, last, kinds, most = laid
        own, before, after, edge, change = self.parts(weights)
        sums = [w[places].sum(axis=1) for w in (own, before, after)]
        score = sums[0].copy()
        score[1:] += np.where(first[1:], 0.0, sums[1][:-1])
        score[:-1] += np.where(last[:-1], 0.0, sums[2][1:])
        score += edge[0] * first + edge[1] * last
        score = np.clip(score, -60, 60)
        emitted = np.stack((np.zeros(len(score)), score), axis=1)
        top = emitted.max(axis=1)
        emitted = np.exp(emitted - top[:, None])
        moves = np.exp(np.clip(change.reshape(KINDS, 2, 2), -20, 20))[kinds]
        moves[first] = 1.0  # the state of another text has no say
        matrices = moves * emitted[:, None, :]
        forward = _scan(matrices, most)[:, 0, :]
        forward = forward / forward.sum(axis=1, keepdims=True)
        following = np.ones_like(matrices)
        following[:-1][~last[:-1]] = matrices[1:][~first[1:]]
        backward = _scan(following, most, backwards=True).sum(axis=2)
        backward /= backward.sum(axis=1, keepdims=True)
        came = np.concatenate((np.full((1, 2), 0.5), forward[:-1]))
        came[first] = (1.0, 0.0)
        pairs = came[:, :, None] * matrices
        log_all = float((np.log(pairs.sum(axis=(1, 2))) + top).sum())
        pairs = pairs * backward[:, None, :]
        pairs /= pairs.sum(axis=(1, 2), keepdims=True)
        good = forward[:, 1] * backward[:, 1]
        return good / (good + forward[:, 0] * backward[:, 0]), pairs, log_all, score

    def loss(self, laid, states, weights):
        """Negative log likelihood with a ridge, and its gradient."""
        places, first, last, kinds, _ = laid
        good, pairs, log_all, score = self.run(laid, weights)
        change = np.clip(self.parts(weights)[4].reshape(KINDS, 2, 2), -20, 20)
        inner = np.flatnonzero(~first)
        came, went = states[inner - 1].astype(int), states[inner].astype(int)
        likely = float(score[states].sum()) + float(change[kinds[inner], came, went].sum())
        gap = good - states
        out = [np.bincount(places.ravel(), np.repeat(g, places.shape[1]), self.bins.count) for g in (
            gap, np.append(np.where(first[1:], 0.0, gap[1:]), 0.0), np.insert(np.where(last[:-1], 0.0, gap[:-1]), 0, 0.0))]
        out.append(np.array([gap[first].sum(), gap[last].sum()]))
        moved = np.zeros((KINDS, 2, 2))
        np.add.at(moved, kinds[inner], pairs[inner])
        np.add.at(moved, (kinds[inner], came, went), -1.0)
        out.append(moved.ravel())
        return log_all - likely + RIDGE * float(weights @ weights) / 2, np.concatenate(out) + RIDGE * weights

    def fit(self, laid, states, rounds: int = ROUNDS) -> "Field":
        return Field(self.bins, descend(lambda w: self.loss(laid, states, w), self.weights, rounds))


def descend(loss, w, rounds: int, memory: int = 8):
    """Minimum of a smooth convex function by limited-memory BFGS with backtracking."""
    value, slope = loss(w)
    steps, turns = [], []
    for _ in range(rounds):
        move, factors = slope.copy(), []
        for s, y in zip(reversed(steps), reversed(turns)):
            factors.append(s @ move / (s @ y))
            move -= factors[-1] * y
        move *= (steps[-1] @ turns[-1]) / (turns[-1] @ turns[-1]) if steps else 1 / max(1.0, np.linalg.norm(slope))
        for s, y, f in zip(steps, turns, reversed(factors)):
            move += (f - y @ move / (s @ y)) * s
        size, fall = 1.0, slope @ move
        while size > 1e-6:
            then, new = loss(w - size * move)
            if then <= value - 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        step, turn = -size * move, new - slope
        w, gain, value, slope = w + step, value - then, then, new
        if step @ turn > 1e-10:
            steps, turns = [*steps, step][-memory:], [*turns, turn][-memory:]
        if gain < 1e-5 * max(1.0, abs(value)):
            break
    return w


def fit_field(table, sizes, labels, rounds=ROUNDS) -> Field:
    """A field for lines with the labels of their texts: all bad lines first, then without those that look good."""
    field = Field(Bins(table))
    laid = field.lay_out(table, sizes)
    states, text = np.repeat(labels.astype(bool), sizes), np.repeat(np.arange(len(sizes)), sizes)
    field = field.fit(laid, states, rounds)
    good = field.run(laid, field.weights)[0]
    worst = np.full(len(sizes), 2.0)
    np.minimum.at(worst, text, good)
    return field.fit(laid, states | ((good > 0.5) & (good > worst[text])), rounds)


def evidence(good, lengths, sizes):
    """(mean of the marginals weighted by line length, its log odds) of every text."""
    at = np.cumsum(sizes) - sizes
    weight = np.maximum(lengths, 1).astype(np.float64)
    share = np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at)
    bound = np.clip(share, 1e-3, 1 - 1e-3)
    return np.stack((share, np.log(bound / (1 - bound))), axis=1)


def _spread(lines):
    """At most WINDOWS runs of WINDOW lines, the first and the others evenly over the text."""
    runs = [lines[i:i + WINDOW] for i in range(0, len(lines), WINDOW)]
    return [runs[i] for i in sorted({round(x) for x in np.linspace(0, len(runs) - 1, WINDOWS)})]


class LineQuality:
    """A field and a curve; None where there was nothing to learn from."""

    def __init__(self, field: Field | None = None, curve=None):
        self.field, self.curve = field, curve

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, sample_rows=SAMPLE_ROWS, id_col="doc_id", text_col="text",
            label_col="quality", seed=12) -> "LineQuality":
        """Learn from the texts of `docs` that `labels` (id, 0 or 1) names."""
        sample = cut_lineage(labelled_sample(docs, labels, sample_rows, id_col, text_col, label_col, seed, 3),
                             "quality-sample")

        def measured(batches):
            for batch in batches:
                rows = []
                for text, label in zip(batch["text"], batch["label"]):
                    for run in _spread(lines_of(text)):
                        rows.append((int(label), measure([run])[0].tobytes()))
                yield pd.DataFrame(rows, columns=["label", "lines"])

        runs = sample.filter("part < 2").select("label", "text").mapInPandas(measured, "label int, lines binary").toPandas()
        runs = runs.sort_values(["label", "lines"])  # one order, so that sums agree between runs
        if runs["label"].nunique() < 2:
            return cls()
        tables = [np.frombuffer(x, np.float32).reshape(-1, len(FEATURES)) for x in runs["lines"]]
        field = fit_field(np.concatenate(tables), np.array([len(x) for x in tables]), runs["label"].to_numpy())

        def judged(batches):
            for batch in batches:
                found = [cls(field).evidence(group) for group in batches_of(batch["text"])]
                shares = np.concatenate(found) if found else np.zeros((0, 2))
                yield pd.DataFrame({"label": batch["label"], "share": shares[:, 0], "odds": shares[:, 1]})

        unseen = sample.filter("part = 2").select("label", "text").mapInPandas(
            judged, "label int, share double, odds double").toPandas().sort_values(["label", "share", "odds"])
        if unseen["label"].nunique() < 2:
            return cls(field, np.array([0.0, 1.0, 0.0]))
        return cls(field, rising(unseen[["share", "odds"]].to_numpy(), unseen["label"].to_numpy(dtype=np.float64)))

    def marginals(self, texts):
        """(marginals, line lengths, lines per text) of a list of texts."""
        cut = [lines_of(text) for text in texts]
        table, sizes = measure(cut)
        laid = self.field.lay_out(table, sizes)
        lengths = np.fromiter((len(line) for lines in cut for line in lines), np.int64, len(table))
        return self.field.run(laid, self.field.weights)[0], lengths, sizes

    def evidence(self, texts):
        return evidence(*self.marginals(texts))

    def scores(self, texts) -> np.ndarray:
        if self.field is None:
            return np.full(len(texts), 0.5)
        x = self.evidence(texts)
        return 1 / (1 + np.exp(-np.clip(x @ self.curve[:-1] + self.curve[-1], -30, 30)))

    def score(self, text_col) -> Column:
        """0 to 1, higher for better texts."""
        model = self

        @F.pandas_udf(DoubleType())
        def scored(texts: pd.Series) -> pd.Series:
            parts = [model.scores(group) for group in batches_of(texts)]
            return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

        return scored(whole_text(text_col))

    def line_scores(self, text_col) -> Column:
        """The marginal of being good of every line of a text, null for blank lines."""
        model = self

        def one(text):
            if model.field is None:
                return [None] * (text.count("\n") + 1)
            good = iter(model.marginals([text])[0].tolist())
            return [next(good) if line.strip() else None for line in text.encode().split(b"\n")]

        @F.pandas_udf("array<double>")
        def scored(texts: pd.Series) -> pd.Series:
            return texts.map(one)

        return scored(whole_text(text_col))


def keep_good(docs: DataFrame, model: LineQuality, threshold=0.3, text_col="text") -> DataFrame:
    """The rows of `docs` that score at least the threshold, with all their columns."""
    scored = docs.select(F.struct("*").alias("row"), model.score(text_col).alias("score"))
    return scored.filter(F.col("score") >= threshold).select("row.*")
