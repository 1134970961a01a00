"""Sharding, mixing and byte-level BPE."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import curation, mixing, sharding, tokens
from tools.compare import difference, duck


@pytest.mark.parametrize("name", ["op8_sharding", "op9_exact_dedup", "op10_mixing"])
def test_agrees_with_sql(spark, small, name):
    from millrace.llm.queries import ORACLES, QUERIES

    assert difference(QUERIES[name](spark, small), duck(small), ORACLES[name]) is None


def brute_shards(rows, shards, seed):
    """Rows (id, source, text) to the list of shards, each a list of ids in slot order."""
    strata = defaultdict(list)
    for i, source, text in rows:
        digest = hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        strata["0" if source is None else "1" + source].append((digest, i))
    order = sorted(((2 * r + 1) / (2 * len(members)), s, *m) for s, members in strata.items()
                   for r, m in enumerate(sorted(members)))
    places = defaultdict(list)
    for p, row in enumerate(order):
        places[p * shards // len(order)].append(row[-1])
    return places


def test_shards_match_the_definition(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    want = brute_shards(rows, 16, curation.SEED)
    got = curation.shards(spark, small).collect()
    texts = {i: t for i, _, t in rows}
    for r in got:
        assert want[r.shard][r.slot] == r.doc_id
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    sizes = [len(s) for s in want.values()]
    assert len(got) == len(rows) and max(sizes) - min(sizes) <= 1


def test_every_shard_holds_the_mixture(spark, make):
    rows = [(i, f"t{i}", "hot" if i % 3 else f"s{i % 7}") for i in range(2000)]
    got = sharding.assign_shards(make(rows), 10, 1).groupBy("shard", "stratum").count().collect()
    total = defaultdict(int)
    for r in got:
        total[r.stratum] += r["count"]
    for r in got:
        assert abs(r["count"] - total[r.stratum] / 10) < 2  # less than one row at either cut


def test_shards_of_odd_rows(spark, odd, empty, make, tmp_path):
    got = sharding.assign_shards(odd, 4).collect()
    assert len(got) == odd.count()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert [r.size for r in got if r.doc_id == 7] == [1]
    assert sharding.assign_shards(empty, 4).count() == 0
    docs = make([(i, f"text {i}", "a") for i in range(40)])
    assigned = sharding.assign_shards(docs, 4)
    sharding.write_shards(docs, assigned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


@pytest.mark.parametrize("part_log2", [1, 16])
def test_written_shards_hold_every_row_once(spark, odd, empty, make, tmp_path, monkeypatch, part_log2):
    monkeypatch.setattr(sharding, "PART_ROWS_LOG2", part_log2)
    hot = make([(None if i % 3 else 5, "hot" if i % 2 else f"t{i}", "a") for i in range(600)]).repartition(5)
    for name, docs in (("odd", odd), ("hot", hot)):
        assigned = sharding.assign_shards(docs, 4)
        sharding.write_shards(docs, assigned, str(tmp_path / name))
        back = spark.read.parquet(str(tmp_path / name))
        assert back.select("row.*").columns == docs.columns
        rows = back.collect()
        assert sorted(str(r.row) for r in rows) == sorted(map(str, docs.collect()))
        crc = {(r.shard, r.slot): (r.row.doc_id, ("0" if r.row.source is None else "1" + r.row.source),
                                   zlib.crc32((r.row.text or "").encode())) for r in rows}
        assert len(crc) == len(rows)
        assert crc == {(r.shard, r.slot): (r.doc_id, r.stratum, r.text_crc32) for r in assigned.collect()}
    sharding.write_shards(empty, sharding.assign_shards(empty, 4), str(tmp_path / "empty"))
    with pytest.raises(Exception, match="not the rows that were assigned"):
        sharding.write_shards(hot.limit(599), sharding.assign_shards(hot, 4), str(tmp_path / "other"))


def brute_targets(sizes, weights, share, most):
    """Share by weight; cap, share the excess among the others, again."""
    total, full, targets = share * sum(sizes), set(), [0.0] * len(sizes)
    while True:
        rest = total - sum(most * sizes[i] for i in full)
        weight = sum(weights[i] for i in range(len(sizes)) if i not in full)
        over = [i for i in range(len(sizes)) if i not in full and rest * weights[i] / weight > most * sizes[i]]
        if not over:
            return [most * sizes[i] if i in full else rest * weights[i] / weight for i in range(len(sizes))]
        full.update(over)


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 20, 0, 500], [1], [5, 5, 5, 5, 5, 5, 4000]])
def test_targets_fill_up(spark, sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    frame = spark.createDataFrame([(f"1s{i}", False, n) for i, n in enumerate(sizes)],
                                  "key string, is_null boolean, source_size bigint")
    got = sorted(mixing.source_targets(frame, (3, 1, 2), 1.5, 2).collect(), key=lambda r: r.key)
    assert [r.target for r in got] == pytest.approx(brute_targets(sizes, weights, 1.5, 2))


def by_source(docs, plan, words):
    """{source: (sizes, target, words taken)}; a row's source is found by its size and target."""
    out = {}
    for r in plan:
        found = out.setdefault((r.source_size, r.target), [[], 0])
        found[0].append(r["size"])
        found[1] += r.taken
    return out


@pytest.mark.parametrize("block", [1, 7, 256])
def test_the_mix_comes_nearest_to_its_targets(spark, odd, words, block):
    got = mixing.mix_plan(odd, (3, 1, 2), block_words=block).collect()
    assert len(got) == odd.count()
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"]) and (r.first_slot is None) == (r.taken == 0)
    for (source_size, wanted), (sizes, taken) in by_source(odd, got, words).items():
        assert abs(taken - wanted) <= max(sizes) / 2 + 1 and taken <= 2 * source_size
    again = mixing.mix_plan(odd.repartition(7), (3, 1, 2), block_words=block).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    for r in odd.collect():
        assert {g["size"] for g in got if g.doc_id == r.doc_id and r.doc_id is not None} in ({len(words(r.text))}, set())


def targets_of(spark, words):
    return spark.createDataFrame([(f"1s{i}", False, w, float(w), w) for i, w in enumerate(words)],
                                 "key string, is_null boolean, source_size bigint, target double, words bigint").cache()


def worst_prefix(slots, shares):
    """How far any source is from its share, in blocks, over all beginnings of the schedule."""
    met, worst = defaultdict(int), 0.0
    for k, key in enumerate([key for _, key in sorted(slots)], 1):
        met[key] += 1
        worst = max([worst, *[abs(met[s] - k * share) for s, share in shares.items()]])
    return worst


@pytest.mark.parametrize("words", [[4500, 1500], [30_000, 10_000, 20_000, 500, 7], [10, 10, 10], [100_000, 1]])
def test_every_beginning_of_the_schedule_holds_the_shares(spark, words, monkeypatch):
    targets = targets_of(spark, words)
    slots = [(r.slot, r.key) for r in mixing.schedule(targets, 10).collect()]
    places = defaultdict(list)
    for r in mixing.schedule(targets, 10).orderBy("slot").collect():
        places[r.key].append(r.place)
    assert all(places[f"1s{i}"] == list(range(-(-w // 10))) for i, w in enumerate(words))
    assert len({slot for slot, _ in slots}) == len(slots)
    shares = {f"1s{i}": w / sum(words) for i, w in enumerate(words)}
    assert worst_prefix(slots, shares) <= 3.5
    if len(slots) > 100 and max(shares.values()) < 0.99:  # points in plain order are no schedule
        monkeypatch.setattr(mixing, "reversed_bits", lambda number, bits: number.cast("bigint"))
        plain = [(r.slot, r.key) for r in mixing.schedule(targets, 10).collect()]
        assert worst_prefix(plain, shares) > 20


def test_an_even_schedule_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 16)
    slots = [(r.slot, r.key) for r in mixing.schedule(targets_of(spark, [4000, 2000]), 10).collect()]
    assert len(slots) == 600 and worst_prefix(slots, {"1s0": 2 / 3, "1s1": 1 / 3}) <= 3.5


def test_mixed_rows(odd, empty, words):
    plan = mixing.mix_plan(odd, (3, 1, 2), block_words=16).collect()
    mixed = mixing.mix(odd, (3, 1, 2), block_words=16, slot_col="at_slot")
    assert mixed.columns == [*odd.columns, "at_slot"]
    rows = mixed.collect()
    assert sum(len(words(r.text)) for r in rows) == sum(r.taken for r in plan)
    whole = {(r.doc_id, r.text, r.source) for r in odd.collect()}
    assert all((r.doc_id, r.text, r.source) in whole for r in rows)
    firsts = {(r.doc_id, r.first_slot) for r in plan if r.taken and r.doc_id is not None}
    assert firsts <= {(r.doc_id, r.at_slot) for r in rows}
    assert mixing.mix_plan(empty, (3, 1, 2)).count() == 0 and mixing.mix(empty, (3, 1, 2)).count() == 0


def test_a_mixture_in_the_order_of_its_slots(make):
    """Words of the first k blocks of the mix hold the sources at their shares."""
    docs = make([(i, "w " * (20 + i % 30), f"s{i % 3}") for i in range(900)])
    plan = mixing.mix_plan(docs, (3, 1, 2), block_words=50).collect()
    rows = sorted((r.at_slot, r.source, len(r.text.split())) for r in mixing.mix(docs, (3, 1, 2), block_words=50, slot_col="at_slot").collect())
    totals, met, seen = defaultdict(int), defaultdict(int), 0
    for _, source, size in rows:
        totals[source] += size
    whole = sum(totals.values())
    assert whole == sum(r.taken for r in plan)
    for _, source, size in rows:
        met[source] += size
        seen += size
        assert all(abs(met[s] - seen * totals[s] / whole) <= 5 * 50 for s in totals)


def test_a_hot_id_is_spread(make, words):
    """Two thirds of the rows without or with one id: they are ranked in ranges of the whole order, not of the id."""
    docs = make([(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"word{i} " * (1 + i % 5), "a") for i in range(900)])
    got = mixing.mix_plan(docs, (3,), share=1.5, block_words=8).collect()
    (sizes, taken), = by_source(docs, got, words).values()
    assert len(got) == 900 and abs(taken - 1.5 * sum(sizes)) <= 4
    ranges = docs.repartitionByRange(32, "source", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.xxhash64("text"))
    assert max(r["count"] for r in ranges.groupBy(F.spark_partition_id()).count().collect()) <= 900 / 32 * 3


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.encoder(tokens.read_ranks(public_tokenizers.path(curation.RANKS)), public_tokenizers.PATTERN)


@pytest.mark.parametrize("text", [
    "", " ", "plain words here", "don't you're  we'll 'stuff", "a  b   c\n\n d\t\te ", "x" * 3000, " " * 3000,
    "12ab34 cd!!??  ..", "漢字 かな　全角 nbsp em ​ zero", "\U0001f600 \U0001f601\n", "a\r\n b\r\n\r\n c ",
    "tail   ", "\n\n\nlead", "'s 't 're", "word" + " " * 40 + "word\n\n\n" * 9])
def test_pieces_give_the_ids_of_the_whole(tokenizer, text):
    for most in (1, 2, 3, 7, 50):
        assert "".join(tokens.safe_pieces(text, most)) == text
        for least in (2, 3, 10, tokens.LONG_SPACE):
            assert tokens.encode_text(tokenizer, text, most, least).tolist() == tokenizer.encode_ordinary(text)


WHITE = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u200b\u2028\u202f\u3000"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(WHITE + "ab1.'"), max_size=60), st.integers(1, 9), st.integers(2, 6))
def test_white_space_of_all_kinds(tokenizer, text, most, least):
    assert tokens.encode_text(tokenizer, text, most, least).tolist() == tokenizer.encode_ordinary(text)


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " \n\t\r" * 500_000])
def test_very_long_white_space(spark, tokenizer, run):
    """More than the library's own search can take; the ids are those of the matches by hand."""
    coder = curation.codec(spark)
    for text, matches in ((run, [run]), (f"one{run}two", ["one", run[:-1], *([" two"] if run[-1] == " " else [run[-1], "two"])])):
        got = spark.createDataFrame([(1, text)], "doc_id long, text string").select(coder.ids("text").alias("ids")).first().ids
        assert got == [i for match in matches for i in tokenizer._encode_single_piece(match)]
        assert tokens.decode_ids(tokenizer, got) == text.encode()


def test_other_patterns_are_not_cut(tokenizer):
    other = tokens.encoder(tokens.read_ranks(public_tokenizers.path(curation.RANKS)), r"[\s\S]{1,5}")
    text = "ab cd\n" * 30
    assert tokens.encode_text(other, text, 7, 2).tolist() == other.encode_ordinary(text)
    assert public_tokenizers.PATTERN == tokens.SPLIT


def test_round_trip_of_odd_rows(spark, odd, empty, tokenizer):
    coder = curation.codec(spark)
    got = curation.token_report(odd, coder).collect()
    want = sorted((str(r.doc_id), len(ids := tokenizer.encode_ordinary(r.text or "")),
                   hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    coded = tokens.decode(tokens.encode(odd, coder), coder)
    assert sorted((str(r.doc_id), len(r.ids), bytes(r.decoded)) for r in coded.collect()) == sorted(
        (str(r.doc_id), len(tokenizer.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in odd.collect())
    assert curation.token_report(empty, coder).count() == 0
    nothing = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r.b) for r in nothing.select(coder.decoded("ids").alias("b")).collect()] == [b"", b""]


def test_cut_ids_decode_to_raw_bytes(spark, tokenizer):
    ids = tokenizer.encode_ordinary("漢")
    one = spark.createDataFrame([(ids[:1],)], "ids array<int>")
    raw = bytes(one.select(curation.codec(spark).decoded(F.col("ids")).alias("b")).first().b)
    assert raw == tokenizer.decode_bytes(ids[:1])
    with pytest.raises(UnicodeDecodeError):
        raw.decode()
    assert isinstance(tokenizer, tiktoken.Encoding)
