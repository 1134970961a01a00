"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash

from millrace.llm import common, exact_dedup, simhash
from millrace.llm.screening import simhash_components


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_groups(rows):
    """(doc_id, text) rows to {normalised text: ids}."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[normal(text)].append(i)
    return groups


def least(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


@pytest.mark.parametrize("tracked", [2, 8, 4096])
def test_exact_decisions(spark, make, tracked):
    random.seed(3)
    texts = ["hot text"] * 300 + ["warm  text"] * 40 + [f"text {i}" for i in range(200)] + [f"pair {i}" for i in range(50)] * 2
    random.shuffle(texts)
    rows = [(i, t.replace(" ", random.choice([" ", "\n", " \t"])) if i % 3 else t, "s") for i, t in enumerate(texts)]
    groups = brute_groups([r[:2] for r in rows])
    got = exact_dedup.decisions(make(rows).repartition(5), tracked=tracked).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        ids = groups[normal(text)]
        assert (by_id[i].keep_id, by_id[i].group_size, by_id[i].kept) == (min(ids), len(ids), i == min(ids))
        assert by_id[i].digest == hashlib.sha256(normal(text).encode()).hexdigest()


def test_exact_on_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    groups = brute_groups(rows)
    got = exact_dedup.decisions(odd).collect()
    assert len(got) == len(rows)
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in got if r.digest == digest]
        assert sorted(r.doc_id is None for r in mine) == sorted(i is None for i in ids)
        assert {r.keep_id for r in mine} == {least(ids)} and {r.group_size for r in mine} == {len(ids)}
        assert sum(r.kept for r in mine) == 1  # repeated rows too leave one
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact_dedup.decisions(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


def brute_simhash(text, shingle=3):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not ws:
        return 0
    parts = [b" ".join(ws[i:i + shingle]) for i in range(len(ws) - shingle + 1)] or [b" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=2):
    """Component number of each fingerprint, by comparing all."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_fingerprints_are_those_of_the_definition(odd):
    got = odd.select("text", simhash.as_hex(simhash.fingerprints("text", 3)).alias("fp")).collect()
    for r in got:
        if r.text is None or len(r.text) < 1000:
            assert r.fp == f"{brute_simhash(r.text):016x}"


def test_bk_tree_finds_all_within_the_radius():
    random.seed(5)
    base = [random.getrandbits(64) for _ in range(20)]
    values = list({b ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for b in base for _ in range(30)})
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values + [random.getrandbits(64) for _ in range(50)]:
        for radius in (0, 1, 2, 3):
            want = [i for i, w in enumerate(values) if (v ^ w).bit_count() <= radius]
            assert sorted(tree.within(v, radius)) == want


@pytest.mark.parametrize("most", [1, 16, 512])
def test_links_join_the_true_components(spark, most):
    """With a low limit all shards are cut again; the components stay the same."""
    random.seed(7)
    centres = [random.getrandbits(64) for _ in range(6)]
    fps = {c for c in centres} | {random.getrandbits(64) for _ in range(200)}
    for c in centres:
        for _ in range(80):
            flips = random.sample(range(64), random.choice([1, 2, 3, 4]))
            fps.add(c ^ sum(1 << b for b in flips))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    entries = spark.createDataFrame([(f,) for f in signed], "fp bigint").cache()
    links = [(r.u, r.v) for r in simhash.fingerprint_links(entries, 2, most).collect()]
    assert all(((u ^ v) & ((1 << 64) - 1)).bit_count() <= 2 for u, v in links)
    place, parent = {f: i for i, f in enumerate(signed)}, list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in links:
        a, b = root(place[u]), root(place[v])
        parent[max(a, b)] = min(a, b)
    want = brute_components(fps)
    assert len(set(want)) < len(fps) - 250
    assert [root(i) for i in range(len(fps))] == want


@pytest.mark.parametrize("radius", [8, 9])
def test_crowded_shards_are_cut_for_wide_radii(spark, radius):
    random.seed(radius)
    low = (1 << (64 // (radius + 1))) - 1
    centres = [random.getrandbits(64) & ~low for _ in range(8)]  # one coarse block is the same in all
    fps = sorted({c ^ sum(1 << b for b in random.sample(range(12, 64), random.randint(0, radius)))
                  for c in centres for _ in range(20)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    entries = spark.createDataFrame([(f,) for f in signed], "fp bigint").cache()
    place, parent = {f: i for i, f in enumerate(signed)}, list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in simhash.fingerprint_links(entries, radius, 4).collect():
        assert ((r.u ^ r.v) & ((1 << 64) - 1)).bit_count() <= radius
        a, b = root(place[r.u]), root(place[r.v])
        parent[max(a, b)] = min(a, b)
    want = []  # as brute_components, for this radius
    for i, f in enumerate(fps):
        want.append(i)
        for j in range(i):
            if (f ^ fps[j]).bit_count() <= radius and want[j] != want[i]:
                old, new = max(want[i], want[j]), min(want[i], want[j])
                want = [new if w == old else w for w in want]
    assert len(set(want)) < len(fps) / 2 and [root(i) for i in range(len(fps))] == want


def test_a_radius_is_cut_or_refused(spark):
    assert simhash._fine_blocks(2) == 8 and all(simhash._fine_blocks(r) > r for r in range(64))
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp bigint"), 64)


def check_components(rows, got):
    fps = [brute_simhash(text) for _, text in rows]
    comps = brute_components(fps)
    smallest = defaultdict(list)
    for (i, _), c in zip(rows, comps):
        smallest[c].append(i)
    want = sorted((str(i), f"{fp:016x}", str(least(smallest[c]))) for (i, _), fp, c in zip(rows, fps, comps))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    return len(smallest)


def test_near_duplicates_on_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    n = check_components(rows, simhash.near_duplicates(odd).collect())
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns and kept.count() == n
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0


def test_op1_on_a_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check_components([(r.doc_id, r.text) for r in docs.collect()], simhash_components(spark, small).collect())


@pytest.mark.parametrize("bits", [1 << 10, 1 << 26])
def test_rows_of_hot_ids_are_decided_exactly(spark, make, monkeypatch, bits):
    """A third of the rows with one id, a third with none, copies among all of them, and a bitmap too small for them."""
    monkeypatch.setattr(common, "FEWEST_BITS", 64)
    monkeypatch.setattr(common, "MOST_BITS", bits)
    rows = [((7, None, i)[i % 3], f"text {i % 400}" if i % 5 else "one text", "s") for i in range(1800)]
    docs = make(rows).repartition(6)
    groups = brute_groups([r[:2] for r in rows])
    kept = exact_dedup.deduplicate(docs).collect()
    assert sorted((str(r.doc_id), normal(r.text)) for r in kept) == sorted((str(least(ids)), text) for text, ids in groups.items())


def test_rows_that_stay_are_not_shuffled(spark, make):
    """The texts that nobody drops pass from the scan to the result without an exchange."""
    docs = make([(i, f"text {i} " + "word " * 200 if i > 20 else "copy", "s") for i in range(2000)]).repartition(4)
    path = common.cut_lineage(docs, "docs")
    kept = exact_dedup.deduplicate(path)
    assert kept.count() == 1980
    exchanged = [0]
    plan = kept._jdf.queryExecution().executedPlan()
    def walk(node):
        name = node.nodeName()
        if name.startswith("Exchange"):
            found = {str(node.output().apply(i)).split("#")[0] for i in range(node.output().size())}
            exchanged[0] += "row" in found or "text" in found
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if name == "AdaptiveSparkPlan":
            walk(node.initialPlan())
    walk(plan)
    assert exchanged[0] <= 1  # the doubtful rows alone
