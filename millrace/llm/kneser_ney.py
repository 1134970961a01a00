"""Interpolated modified Kneser-Ney bigram model, counted in Spark, looked up in memory-mapped arrays.

A word stands for the XXH64 of its bytes; a batch's words are hashed together, a step at a time. Three passes over the text, each a Spark job whose tasks hold one batch (about 1 MB of text, or the longest single text,
at some 60 bytes a character):

1. vocabulary: every batch sends its distinct token hashes with counts, cut by hash into shards; a task
   merges a shard and writes it as a sorted array. The place of a hash in the shards is the token's id.
2. bigrams: every batch sends its distinct (context id, token id) pairs with counts, cut by pair into
   shards, so no word, however frequent, meets in one task; a task merges a shard, writes the sorted
   pair keys with their counts, and sends on, per id, how many pairs of each count an id opens and how
   many it closes. Those are summed by ranges of ids in two last small steps, first within groups of pair
   shards, so that neither step meets more than about the square root of their number, and written as arrays by id.
3. scoring: workers look up their batch's distinct tokens and pairs in the shards they need, one shard
   at a time, memory-mapped, so neither a worker's memory nor its open files grow with the model.

With c the count of a pair, D the discount for that count, N_i(v.) the pairs of count i that v opens:
    p(w | v) = (c(vw) - D(c(vw))) / c(v.) + (D1 N1(v.) + D2 N2(v.) + D3 N3+(v.)) / c(v.) * p(w)
    p(w)     = (N(.w) - d(N(.w))) / N(..) + (d1 M1 + d2 M2 + d3 M3+) / N(..) / (V + 1)
where N(.w) is the number of distinct contexts of w, M_i the number of words with i contexts, and the
discounts of both orders come from counts of counts (Chen and Goodman). A context never seen leaves
p(w). The probabilities of the known words and one unknown word sum to one after any context.

The files live in a folder that all workers see by the same path (`spark.checkpoint.dir` by default); a
task writes a shard under another name first and renames it, so a task that runs again does no harm.

Defined results: a null text counts as the empty one: one end token; repeated rows and ids get a row
each; without training rows every token has p = 1 / (V + 1) with V = 0; an empty table gives no rows;
other columns are not read.
"""

import json
import os
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import whole_text
from millrace.session import scratch_path

VOCABULARY_TOKENS = 1 << 21  # text tokens to a vocabulary shard
PAIR_TOKENS = 1 << 20        # text tokens to a pair shard
ID_RANGE = 1 << 18           # ids to a file of id statistics
_BITS = 32                   # of an id in a pair key
_TOGETHER = 1 << 20          # characters tokenised together
_HELD = 1 << 22              # distinct keys a batch holds before it sends them on
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# fixed values: the primes of XXH64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
END = np.uint64(1)  # the end token's hash, kept apart from every word's
_CODEC = "zstd"


def _mixed(h):
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _turned(x, bits):
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def word_hashes(data: bytes, starts, lengths, seed: int = 0):
    """XXH64 of words given by their places in `data`, which 8 bytes or more follow: words of less than 32
    bytes all at once, a step of the hash at a time, longer ones by the library."""
    eight, four, one = (np.ndarray((len(data) - 7,), kind, data, strides=(1,)) for kind in ("<u8", "<u4", "u1"))
    h = (_P5 + np.uint64(seed)) + lengths.astype(np.uint64)
    long = np.flatnonzero(lengths >= 32)
    at, left = starts.copy(), lengths.copy()
    left[long] = 0
    for _ in range(3):
        some = np.flatnonzero(left >= 8)
        h[some] = _turned(h[some] ^ (_turned(eight[at[some]] * _P2, 31) * _P1), 27) * _P1 + _P4
        at[some] += 8
        left[some] -= 8
    some = np.flatnonzero(left >= 4)
    h[some] = _turned(h[some] ^ (four[at[some]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[some] += 4
    left[some] -= 4
    for _ in range(3):
        some = np.flatnonzero(left > 0)
        h[some] = _turned(h[some] ^ (one[at[some]].astype(np.uint64) * _P5), 11) * _P1
        at[some] += 1
        left[some] -= 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    for i in long.tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + lengths[i]], seed)
    return np.where(h == END, np.uint64(3), h)


def token_hashes(texts):
    """(hashes of the words of all texts, each text closed by END; how many tokens each text has)."""
    datas = [text.encode().lower() for text in texts]  # of bytes: A-Z alone
    joined = b" ".join(datas) + b" " * 8
    lengths = np.fromiter(map(len, datas), dtype=np.int64, count=len(datas))
    ends_of_texts = np.cumsum(lengths + 1)  # just behind the blank that closes a text
    word = ~_SPACE[np.frombuffer(joined, dtype=np.uint8)]
    change = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = change[0::2], change[1::2]
    hashes = word_hashes(joined, starts, ends - starts)
    before = np.searchsorted(starts, ends_of_texts)  # words up to the end of each text
    counts = np.diff(np.concatenate(([0], before))) + 1
    is_end = np.zeros(len(starts) + len(datas), dtype=bool)
    is_end[before + np.arange(len(datas))] = True
    tokens = np.empty(len(is_end), dtype=np.uint64)
    tokens[is_end], tokens[~is_end] = END, hashes
    return tokens, counts


def batches_of(texts):
    """Lists of texts of bounded total length (a longer text is a list of its own)."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= _TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def _merged(keys, counts):
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


def _packed(keys, counts):
    """Sorted keys as differences, and counts, byte planes apart, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    raw = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(keys).to_bytes(8, "little") + pa.compress(raw, codec=_CODEC, asbytes=True)


def _unpacked(data):
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=16 * n, codec=_CODEC, asbytes=True), dtype=np.uint8)
    columns = np.ascontiguousarray(planes.reshape(16, n)[:8].T), np.ascontiguousarray(planes.reshape(16, n)[8:].T)
    return np.cumsum(columns[0].view(np.uint64).ravel(), dtype=np.uint64), columns[1].view(np.int64).ravel()


def _by_shard(keys, counts, shard_of, shards):
    """Rows (shard, packed part) of sorted distinct keys."""
    where = shard_of(keys, shards)
    order = np.argsort(where, kind="stable")
    keys, counts, where = keys[order], counts[order], where[order]
    edges = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1], [True]))) if len(where) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(where[a]), _packed(keys[a:b], counts[a:b])


def _hash_shard(keys, shards):
    """Ranges of the hash, so that shards in order are sorted as a whole."""
    return np.minimum((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.uint64(shards - 1)).astype(np.int64)


def _pair_shard(keys, shards):
    return ((_mixed(keys) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _counted(batches, keys_of, shard_of, shards):
    """Rows (shard, packed part) with the counts of the keys that `keys_of` finds in lists of texts."""
    def sent(kept):
        keys, counts = _merged(*(np.concatenate(x) for x in zip(*kept)))
        return pd.DataFrame(list(_by_shard(keys, counts, shard_of, shards)), columns=["shard", "data"])

    kept, held = [], 0
    for batch in batches:
        for group in batches_of(batch["text"]):
            keys = keys_of(group)
            kept.append(_merged(keys, np.ones(len(keys), dtype=np.int64)))
            held += len(kept[-1][0])
            if held >= _HELD:
                yield sent(kept)
                kept, held = [], 0
    if kept:
        yield sent(kept)


def _narrow(array):
    """The same counts in the smallest unsigned type that holds them."""
    return array.astype(np.min_scalar_type(int(array.max(initial=0))))


def _write(path, array):
    part = f"{path}.{os.getpid()}-{np.random.default_rng().integers(1 << 62)}"
    with open(part, "wb") as out:
        np.save(out, array)
    os.replace(part, path)


def _folder(path):
    """The folder as the workers open it; only mounted paths can be memory-mapped."""
    where = urlparse(path)
    if where.scheme not in ("", "file"):
        raise ValueError(f"the model needs a folder that all workers mount, not {path}")
    return where.path


def _gather(parts, folder, name, finish, schema, partitions):
    """Merge all packed parts of each shard in the task that gets it; `finish(shard, keys, counts)`
    writes the shard and gives rows."""
    def merge(batches):
        held, waiting = None, []

        def done():
            pieces = [_unpacked(data) for data in waiting]
            keys, counts = _merged(*(np.concatenate(x) for x in zip(*pieces)))
            return finish(folder, held, keys, counts)

        for batch in batches:
            for shard, data in zip(batch["shard"], batch["data"]):
                if shard != held and waiting:
                    yield done()
                    waiting = []
                held = shard
                waiting.append(data)
        if waiting:
            yield done()

    return parts.repartition(partitions, "shard").sortWithinPartitions("shard").mapInPandas(merge, schema)


def _write_vocabulary(folder, shard, keys, counts):
    _write(f"{folder}/word-{shard}.npy", keys)
    _write(f"{folder}/count-{shard}.npy", counts)
    return pd.DataFrame({"shard": [shard], "n": [len(keys)], "tokens": [int(counts.sum())]})


def _write_pairs(folder, shard, keys, counts):
    _write(f"{folder}/pair-{shard}.npy", keys)
    _write(f"{folder}/times-{shard}.npy", _narrow(counts))
    contexts, words = keys >> np.uint64(_BITS), keys & np.uint64((1 << _BITS) - 1)
    opened, first = np.unique(contexts, return_index=True)
    ones, twos, more = (np.add.reduceat(x.astype(np.int64), first) for x in (counts == 1, counts == 2, counts >= 3))
    total = np.add.reduceat(counts, first)
    closed, contexts_of = np.unique(words, return_counts=True)
    rows = []
    for ids, values in ((opened, (ones, twos, more, total)), (closed, (contexts_of,))):
        spans = (ids // ID_RANGE).astype(np.int64)
        edges = np.flatnonzero(np.concatenate(([True], spans[1:] != spans[:-1], [True])))
        for a, b in zip(edges[:-1], edges[1:]):
            planes = [(ids[a:b] % ID_RANGE).astype(np.uint32)] + [v[a:b] for v in values]
            raw = b"".join(x.astype(np.uint32 if n == 0 else np.int64).tobytes() for n, x in enumerate(planes))
            rows.append((int(spans[a]), len(values), int(b - a), pa.compress(raw, codec=_CODEC, asbytes=True)))
    sizes = np.bincount(np.minimum(counts, 5), minlength=6)
    rows.append((-1, 0, 0, json.dumps(sizes.tolist()).encode()))
    return pd.DataFrame(rows, columns=["shard", "planes", "n", "data"])


class KneserNey:
    """A fitted model: a folder of arrays and a few numbers."""

    def __init__(self, folder, numbers):
        self.folder, self.numbers = folder, numbers

    @classmethod
    def fit(cls, docs: DataFrame, text_col="text", folder: str | None = None) -> "KneserNey":
        spark = docs.sparkSession
        folder = _folder(folder or scratch_path(spark, "kneser-ney"))
        os.makedirs(folder, exist_ok=True)
        texts = docs.select(whole_text(text_col).alias("text"))
        # tokens are at most bytes / 2 + 1; a rough count is enough to choose shard sizes
        size, rows = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
        about = size // 6 + rows
        words, pairs = 1 + about // VOCABULARY_TOKENS, 1 + about // PAIR_TOKENS

        def vocabulary_parts(batches):
            yield from _counted(batches, lambda group: token_hashes(group)[0], _hash_shard, words)

        part = "shard bigint, data binary"
        shards = _gather(texts.mapInPandas(vocabulary_parts, part), folder, "vocabulary", _write_vocabulary,
                         "shard bigint, n bigint, tokens bigint", words)
        starts, total = np.zeros(words + 1, dtype=np.int64), 0
        for row in shards.collect():  # one row a shard
            starts[row["shard"] + 1], total = row["n"], total + row["tokens"]
        starts = np.cumsum(starts)
        if starts[-1] >= (1 << _BITS) - 1:
            raise ValueError(f"{starts[-1]} distinct tokens do not fit pair keys of {2 * _BITS} bits")
        numbers = {"starts": starts.tolist(), "tokens": total, "vocabulary": int(starts[-1]), "pair_shards": pairs}
        model = cls(folder, numbers)

        def pairs_of(group):
            tokens, counts = token_hashes(group)
            return model.pair_keys(model.ids(tokens), counts)

        def pair_parts(batches):
            yield from _counted(batches, pairs_of, _pair_shard, pairs)

        statistics = _gather(texts.mapInPandas(pair_parts, part), folder, "pairs", _write_pairs,
                             "shard bigint, planes int, n bigint, data binary", pairs)
        last = int(starts[-1]) + 1  # the context of a text's first word
        ranges = last // ID_RANGE + 1

        groups = int(np.ceil(np.sqrt(pairs)))

        def summed(batches, finish):
            """The statistics of each (id range, group) of a sorted stream added up; `finish` them."""
            held, opened, closed = None, None, None
            sizes = np.zeros(6, dtype=np.int64)
            for batch in batches:
                for shard, part, planes, n, data in zip(batch["shard"], batch["part"], batch["planes"], batch["n"], batch["data"]):
                    if shard == -1:
                        sizes += np.array(json.loads(data), dtype=np.int64)
                        continue
                    if (shard, part) != held:
                        if held is not None:
                            yield finish(*held, opened, closed)
                        held = shard, part
                        opened, closed = np.zeros((4, ID_RANGE), dtype=np.int64), np.zeros(ID_RANGE, dtype=np.int64)
                    raw = pa.decompress(data, decompressed_size=n * (4 + 8 * planes), codec=_CODEC, asbytes=True)
                    ids = np.frombuffer(raw[:4 * n], dtype=np.uint32)
                    values = np.frombuffer(raw[4 * n:], dtype=np.int64).reshape(planes, n)
                    if planes == 4:
                        opened[:, ids] += values
                    else:
                        closed[ids] += values[0]
            if held is not None:
                yield finish(*held, opened, closed)
            yield sizes

        def within_groups(batches):
            def rows(shard, part, opened, closed):
                out = []
                for values in (opened, closed[None]):
                    ids = np.flatnonzero(values.any(axis=0))
                    raw = ids.astype(np.uint32).tobytes() + np.ascontiguousarray(values[:, ids]).tobytes()
                    out.append((shard, 0, len(values), len(ids), pa.compress(raw, codec=_CODEC, asbytes=True)))
                return out

            for found in summed(batches, rows):
                if isinstance(found, np.ndarray):
                    found = [(-1, 0, 0, 0, json.dumps(found.tolist()).encode())]
                yield pd.DataFrame(found, columns=["shard", "part", "planes", "n", "data"])

        def over_groups(batches):
            def rows(shard, part, opened, closed):
                used = slice(0, last + 1 - shard * ID_RANGE)
                _write(f"{folder}/opened-{shard}.npy", _narrow(opened[:, used]))
                _write(f"{folder}/closed-{shard}.npy", _narrow(closed[used]))
                return 1, np.bincount(np.minimum(closed, 5), minlength=6).tolist()

            out = [(2, found.tolist()) if isinstance(found, np.ndarray) else found for found in summed(batches, rows)]
            yield pd.DataFrame(out, columns=["order", "sizes"])

        def dealt(rows, tasks):
            spread = F.when(F.col("shard") < 0, F.pmod(F.xxhash64("data"), F.lit(tasks))).otherwise(
                F.pmod(F.xxhash64("shard", "part"), F.lit(tasks)))
            return rows.withColumn("spread", spread).repartition(tasks, "spread").drop("spread").sortWithinPartitions("shard", "part")

        sizes = {1: np.zeros(6, dtype=np.int64), 2: np.zeros(6, dtype=np.int64)}
        part = F.pmod(F.xxhash64("n", "data"), F.lit(groups)).cast("bigint")
        shape = "shard bigint, part bigint, planes int, n bigint, data binary"
        first = dealt(statistics.withColumn("part", part), min(4 * ranges * groups, pairs + ranges)).mapInPandas(within_groups, shape)
        for row in dealt(first, 4 * ranges).mapInPandas(over_groups, "order int, sizes array<bigint>").collect():  # counts of counts
            sizes[row["order"]] += np.array(row["sizes"], dtype=np.int64)
        for order, of in sizes.items():
            n1, n2, n3, n4 = (int(x) for x in of[1:5])
            y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            d = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y]
            numbers[f"discounts_{order}"] = [0.0, *(min(max(x, 0.0), float(i + 1)) for i, x in enumerate(d))]
        continuation = sizes[1]
        numbers["pairs"] = int(sizes[2][1:].sum())
        d = numbers["discounts_1"]
        numbers["left_over"] = (d[1] * int(continuation[1]) + d[2] * int(continuation[2])
                                + d[3] * int(continuation[3:].sum()))
        return model

    def ids(self, tokens: np.ndarray) -> np.ndarray:
        """Vocabulary ids, -1 for tokens that are not in it."""
        distinct, inverse = np.unique(tokens, return_inverse=True)
        starts = self.numbers["starts"]
        found = np.full(len(distinct), -1, dtype=np.int64)
        where = _hash_shard(distinct, len(starts) - 1)
        for shard in np.unique(where).tolist():
            if starts[shard] == starts[shard + 1]:
                continue
            words = np.load(f"{self.folder}/word-{shard}.npy", mmap_mode="r")
            mine = slice(*np.searchsorted(where, [shard, shard + 1]))
            places = np.searchsorted(words, distinct[mine])
            places[places == len(words)] = 0
            found[mine] = np.where(words[places] == distinct[mine], places + starts[shard], -1)
        return found[inverse]

    def counts_of(self, ids):
        """How often the tokens of these ids were met in training; 0 for id -1."""
        distinct, inverse = np.unique(ids, return_inverse=True)
        starts, out = np.array(self.numbers["starts"]), np.zeros(len(distinct), dtype=np.int64)
        where = np.searchsorted(starts, distinct, side="right") - 1
        for shard in np.unique(where[distinct >= 0]).tolist():
            mine = where == shard
            out[mine] = np.load(f"{self.folder}/count-{shard}.npy", mmap_mode="r")[distinct[mine] - starts[shard]]
        return out[inverse]

    def pair_keys(self, ids, counts):
        """One key a token: its context (0 at a text's beginning, else the id before plus 1) and its id
        plus 1. Keys of unknown ids have a 0 there, which no stored pair has."""
        contexts = np.concatenate(([-1], ids[:-1])) + 1
        begins = np.cumsum(counts) - counts
        contexts[begins] = self.numbers["vocabulary"] + 1
        return (contexts.astype(np.uint64) << np.uint64(_BITS)) | (ids + 1).astype(np.uint64)

    def _by_id(self, name, ids, rows):
        out = np.zeros((rows, len(ids)), dtype=np.int64)
        where = ids // ID_RANGE
        for part in np.unique(where).tolist():
            path = f"{self.folder}/{name}-{part}.npy"
            if os.path.exists(path):
                mine = where == part
                values = np.load(path, mmap_mode="r")
                out[:, mine] = values.reshape(rows, -1)[:, ids[mine] % ID_RANGE]
        return out

    def log10_probabilities(self, ids, counts):
        """log10 p of every token of texts given one after the other."""
        keys, inverse = np.unique(self.pair_keys(ids, counts), return_inverse=True)
        contexts, words = (keys >> np.uint64(_BITS)).astype(np.int64), (keys & np.uint64((1 << _BITS) - 1)).astype(np.int64)
        times = np.zeros(len(keys), dtype=np.int64)
        where = _pair_shard(keys, self.numbers["pair_shards"])
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(self.numbers["pair_shards"] + 1))
        for shard in np.unique(where).tolist():
            mine = order[edges[shard]:edges[shard + 1]]
            path = f"{self.folder}/pair-{shard}.npy"
            if not os.path.exists(path):
                continue
            stored = np.load(path, mmap_mode="r")
            places = np.searchsorted(stored, keys[mine])
            places[places == len(stored)] = 0
            hit = stored[places] == keys[mine]
            times[mine[hit]] = np.load(f"{self.folder}/times-{shard}.npy", mmap_mode="r")[places[hit]]
        known, to_context = np.unique(contexts, return_inverse=True)
        n1, n2, n3, total = self._by_id("opened", known, 4)
        d1, d2 = np.array(self.numbers["discounts_1"]), np.array(self.numbers["discounts_2"])
        left = np.where(total > 0, (d2[1] * n1 + d2[2] * n2 + d2[3] * n3) / np.maximum(total, 1), 1.0)[to_context]
        total = np.maximum(total, 1)[to_context]
        distinct, to_word = np.unique(words, return_inverse=True)
        preceded = self._by_id("closed", distinct, 1)[0]
        all_pairs = max(self.numbers["pairs"], 1)
        spread = self.numbers["left_over"] / all_pairs if self.numbers["pairs"] else 1.0
        lower = (preceded - d1[np.minimum(preceded, 3)]) / all_pairs + spread / (self.numbers["vocabulary"] + 1)
        p = (times - d2[np.minimum(times, 3)]) / total + left * lower[to_word]
        return np.log10(p)[inverse]

    def score(self, docs: DataFrame, id_col="doc_id", text_col="text", *more: Column) -> DataFrame:
        """(doc_id, n_tokens, n_known, unigram_score, score) and `more` columns for every row of `docs`.

        score is the log10 probability of the text with its end; unigram_score that of add-one unigrams.
        """
        model = self

        @F.pandas_udf("n_tokens bigint, n_known bigint, unigram_score double, score double")
        def scored(texts: pd.Series) -> pd.DataFrame:
            n, v = model.numbers["tokens"], model.numbers["vocabulary"]
            parts = []
            for group in batches_of(texts):
                tokens, counts = token_hashes(group)
                ids = model.ids(tokens)
                begins = np.cumsum(counts) - counts
                met = model.counts_of(ids)
                parts.append((counts, np.add.reduceat((ids >= 0).astype(np.int64), begins),
                              np.add.reduceat(np.log10((met + 1) / (n + v + 1)), begins),
                              np.add.reduceat(model.log10_probabilities(ids, counts), begins)))
            columns = [np.concatenate(x) for x in zip(*parts)] if parts else [[]] * 4
            return pd.DataFrame(dict(zip(["n_tokens", "n_known", "unigram_score", "score"], columns)))

        rows = docs.select(F.col(id_col).alias("doc_id"), *more, scored(whole_text(text_col)).alias("_scored"))
        return rows.select(*[c for c in rows.columns if c != "_scored"], "_scored.*")


def perplexity(score, n_tokens) -> Column:
    return F.pow(F.lit(10.0), -F.col(score) / F.col(n_tokens))
