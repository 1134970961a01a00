"""Improbable-feature digests: Bloom filter chains over a text's rarest byte windows.

* Every window of `WINDOW` bytes has an entropy class (0 to `CLASSES`). A corpus-wide histogram of the
  classes, counted over all windows of all texts, ranks them: the rarer a class, the smaller its rank.
  Windows of hardly any entropy (runs, padding) carry no information and have the worst rank.
* In every run of `SPAN` neighbouring windows the one of least rank, leftmost on ties, scores a point;
  windows with `POINTS` points or more are the text's features, kept in order.
* Features are hashed into a chain of Bloom filters of `BITS` bits, `HASHES` bits each, at most
  `FEATURES` features in a filter.
* Two digests are compared filter by filter: common bits above what chance gives, over the most that
  could be common. Every filter of the shorter chain takes its best partner in the other, and the
  average is the likeness (0 to 1).

Entropies of all windows of a text come from counts of equal bytes at each distance, added up in numpy,
block by block, so that memory does not grow with the text.

Defined results: a null text counts as the empty one, whose digest is empty; a non-empty text shorter
than a window, or whose windows all lack entropy, is a single feature; two empty digests have likeness
1, an empty and another one 0; equal texts have equal digests; repeated rows get a row each.
"""

import base64

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from millrace.llm.common import whole_text

WINDOW = 32
SPAN = 64
POINTS = 16
CLASSES = 1000
LEAST_CLASS = 100
BITS, HASHES, FEATURES = 2048, 5, 160
_BLOCK = 1 << 15
_TOGETHER = 1 << 20  # texts are worked on together up to about this many bytes

# an entropy is kept as an integer multiple of 2^-20, so that sums are exact in any order
_PART = np.array([0] + [round(c * np.log2(c) * (1 << 20)) for c in range(1, WINDOW + 2)], dtype=np.int32)
_GAIN = _PART[1:] - _PART[:-1]  # what one more occurrence of a byte that is there c times adds
_MOST = int(_PART[WINDOW])


def _classes_of_block(data: np.ndarray) -> np.ndarray:
    """The entropy class of every window of `data` (at least WINDOW bytes)."""
    n = len(data)
    ahead, behind = np.zeros(n, dtype=np.uint8), np.zeros(n, dtype=np.uint8)
    same = np.empty(n, dtype=bool)
    for distance in range(1, WINDOW):
        equal = np.equal(data[:-distance], data[distance:], out=same[:n - distance]).view(np.uint8)
        ahead[:-distance] += equal
        behind[distance:] += equal
    sums = np.empty(n - WINDOW + 1, dtype=np.int64)
    sums[0] = _PART[np.bincount(data[:WINDOW])].sum()
    np.cumsum(_GAIN[behind[WINDOW:]] - _GAIN[ahead[:n - WINDOW]], out=sums[1:])
    sums[1:] += sums[0]
    return ((_MOST - sums) * CLASSES // _MOST).astype(np.int16)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    if len(data) < WINDOW:
        return np.zeros(0, dtype=np.int16)
    starts = range(0, len(data) - WINDOW + 1, _BLOCK)
    return np.concatenate([_classes_of_block(data[at:at + _BLOCK + WINDOW - 1]) for at in starts])


def with_classes(texts):
    """(bytes, entropy classes of its windows) of every text, worked out for many short texts at once."""
    def classed(group):
        joined = entropy_classes(np.frombuffer(b"".join(group), dtype=np.uint8))
        at = 0
        for data in group:
            yield data, joined[at:at + max(0, len(data) - WINDOW + 1)]
            at += len(data)

    group, size = [], 0
    for text in texts:
        group.append(text.encode())
        size += len(group[-1])
        if size >= _TOGETHER:
            yield from classed(group)
            group, size = [], 0
    yield from classed(group)


def class_histogram(docs: DataFrame, text_col="text") -> np.ndarray:
    """Windows per entropy class over all texts: one row per class comes to the driver."""
    def counted(batches):
        total = np.zeros(CLASSES + 1, dtype=np.int64)
        for batch in batches:
            for _, classes in with_classes(batch["text"]):
                total += np.bincount(classes, minlength=CLASSES + 1)
        met = np.flatnonzero(total)
        yield pd.DataFrame({"class": met, "n": total[met]})

    counts = docs.select(whole_text(text_col).alias("text")).mapInPandas(counted, "class bigint, n bigint")
    histogram = np.zeros(CLASSES + 1, dtype=np.int64)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n")).collect():
        histogram[row["class"]] = row["n"]
    return histogram


def rarity_ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of every entropy class: rarest first; classes below LEAST_CLASS last."""
    order = sorted(range(CLASSES + 1), key=lambda c: (c < LEAST_CLASS, histogram[c], c))
    ranks = np.empty(CLASSES + 1, dtype=np.int64)
    ranks[order] = np.arange(CLASSES + 1)
    return ranks


def feature_starts(classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Where the selected windows start, from the windows' entropy classes.

    Runs are shorter in texts of few windows, so that these have several features too.
    """
    n = len(classes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    span = min(SPAN, max(1, n // 8))
    bits = max(1, int(n).bit_length())
    kind = np.int32 if bits <= 20 else np.int64
    keys = (ranks.astype(kind) << bits)[classes] | np.arange(n, dtype=kind)  # leftmost of equal ranks
    width = 1
    while width < span:  # sliding minimum by doubling
        step = min(width, span - width)
        keys = np.minimum(keys[:len(keys) - step], keys[step:])
        width += step
    places = keys & ((1 << bits) - 1)  # never falls from one run to the next
    edges = np.flatnonzero(places[1:] != places[:-1]) + 1
    points = np.diff(np.concatenate(([0], edges, [len(places)])))
    places = places[np.concatenate(([0], edges))]
    return places[(points >= min(POINTS, max(1, span // 4))) & (classes[places] >= LEAST_CLASS)]


def chain(data: bytes, classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The digest: rows of BITS / 8 bytes, one Bloom filter each."""
    if not data:
        return np.zeros((0, BITS // 8), dtype=np.uint8)
    windows = [data[at:at + WINDOW] for at in feature_starts(classes, ranks).tolist()] or [data]
    distinct = list(dict.fromkeys(map(xxhash.xxh3_128_digest, windows)))
    words = np.frombuffer(b"".join(distinct), dtype="<u2").reshape(-1, 8)[:, :HASHES] % BITS
    filters = np.zeros((-(-len(distinct) // FEATURES), BITS), dtype=bool)
    filters[np.repeat(np.arange(len(distinct)) // FEATURES, HASHES), words.ravel()] = True
    return np.packbits(filters, axis=1)


def to_text(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def from_text(digest: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(digest), dtype=np.uint8).reshape(-1, BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the filters of the shorter chain of the best normalised overlap with a filter of the
    other; of chains equally long, the mean of both directions."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    x, y = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    n, m = np.bitwise_count(x).sum(axis=1, dtype=np.float64), np.bitwise_count(y).sum(axis=1, dtype=np.float64)
    rows, columns = np.zeros(len(x)), np.zeros(len(y))
    for i, filter_bits in enumerate(x):  # one filter against the other chain: memory follows the chain
        common = np.bitwise_count(y & filter_bits).sum(axis=1, dtype=np.float64)
        chance, most = n[i] * m / BITS, np.minimum(n[i], m)
        score = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0)
        rows[i] = score.max()
        np.maximum(columns, score, out=columns)
    return float(rows.mean()) if len(a) < len(b) else float((rows.mean() + columns.mean()) / 2)


class Digester:
    """Digests with the rarity ranks of one corpus."""

    def __init__(self, histogram: np.ndarray):
        self.ranks = rarity_ranks(histogram)

    def digests(self, texts):
        """The digest of every text of a list, in order."""
        return [chain(data, classes, self.ranks) for data, classes in with_classes(texts)]

    def column(self, text_col):
        digester = self

        @F.pandas_udf(StringType())
        def digested(texts: pd.Series) -> pd.Series:
            return pd.Series([to_text(digest) for digest in digester.digests(texts)], dtype="object")

        return digested(whole_text(text_col))


def likeness_of(a, b) -> Column:
    """The likeness of two digest columns."""
    @F.pandas_udf(DoubleType())
    def compared(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([likeness(from_text(p), from_text(q)) for p, q in zip(x, y)], dtype="float64")

    return compared(a, b)


def fingerprint(docs: DataFrame, histogram: np.ndarray | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, fingerprint) for every row; without `histogram` the ranks are those of `docs` itself."""
    digester = Digester(class_histogram(docs, text_col) if histogram is None else histogram)
    return docs.select(F.col(id_col).alias("doc_id"), digester.column(text_col).alias("fingerprint"))
