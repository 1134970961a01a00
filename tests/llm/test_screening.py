"""Toxicity, URL filter, secret scan, language model and fingerprints."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import common, fingerprints, kneser_ney, screening, secret_scan, toxicity, urls
from tools.compare import difference, duck


def evidence(text, lexicon=None):
    return toxicity.Evidence(lexicon or {w: toxicity.KNOWN_WEIGHT for w in toxicity.INSULTS}).of(text)[0]


def test_the_grammar_weighs_clauses():
    plain = evidence("what an idiot")
    assert plain > 0 and evidence("") == evidence("a fine day") == 0
    assert evidence("you idiot") > plain and evidence("an idiot, you see") > plain  # a target in the clause
    assert evidence("this is not an idiot") < plain  # negation before, within its scope
    assert evidence("not this or that long way off idiot") == plain  # beyond its scope
    assert evidence("it is not so. what an idiot") == plain  # another clause
    assert evidence("the man said what an idiot") < plain  # reported speech
    assert evidence("they kill time") == 0 < evidence("I will kill you") and evidence("you they will kill") > 0
    assert evidence("IDIOT!") == evidence("idiot") and evidence("nonidiot") == 0


def test_composition_feeds_one_into_the_other():
    rename = toxicity.Transducer(0, {(0, "insult"): (0, "threat", 2.0)})
    count = toxicity.Transducer(0, {(0, "threat"): (1, "threat", 3.0), (1, "threat"): (1, "threat", 5.0)})
    machine = toxicity.compose(rename, count)
    assert toxicity.clause_weight(machine, [("insult", 1.0), ("other", 0.0), ("threat", 1.0)]) == 2 * 3 + 5


def labelled(make, spark, n=600):
    random.seed(2)
    vocabulary = ["".join(random.choices("bcdfgklmnprst", k=3)) + random.choice("aeiou") * 2 for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        ws = random.choices(vocabulary, k=random.randint(3, 120))
        toxic = i % 5 == 0
        for _ in range(random.randint(2, 5) if toxic else 0):
            ws.insert(random.randrange(len(ws)), random.choice(["grobnik", "snarf"]) + random.choice(["", "aba", "olo"]))
        rows.append((i, " ".join(ws), "s"))
        labels.append((i, int(toxic)))
    return make(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_words_are_learned_from_labels(spark, make, odd, empty):
    docs, labels = labelled(make, spark)
    known = labels.filter("doc_id < 300").unionByName(spark.createDataFrame([(None, 1), (5, None)], labels.schema))
    model = toxicity.ToxicityModel.fit(docs, known)
    scored = docs.select("doc_id", model.score("text").alias("s")).join(labels, "doc_id").filter("doc_id >= 300").collect()
    assert all((r.s >= 0.7) == (r.toxic == 1) for r in scored)
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns and kept.count() < 600
    odd_scores = [r.s for r in odd.select(model.score("text").alias("s")).collect()]
    assert len(odd_scores) == odd.count() and all(0 <= s < 0.7 for s in odd_scores)
    assert toxicity.reject(empty, model).count() == 0
    untaught = toxicity.ToxicityModel.fit(docs, labels.filter("toxic = 5"))
    assert untaught.curve is toxicity.ToxicityModel.FALLBACK


def test_a_hot_id_with_many_labels_gives_one_text(spark, make):
    """A third of 3,000 rows on one id with three labels, two thirds on their own: the sample stays bounded."""
    rows = [(1 if i % 3 == 0 else i + 10, f"word{i} here", "s") for i in range(3000)]
    docs = make(rows)
    labels = spark.createDataFrame([(1, 1)] * 3 + [(i + 10, i % 2) for i in range(3000) if i % 3], "doc_id bigint, toxic int")
    sample = common.labelled_sample(docs, labels, 100_000, "doc_id", "text", "toxic", 11, 2)
    assert sample.count() == 1 + 2000 and sample.filter("text rlike 'word(0|3|6|9) here'").count() <= 1
    assert common.labelled_sample(docs, labels, 8, "doc_id", "text", "toxic", 11, 2).count() < 40
    both = labels.unionByName(spark.createDataFrame([(1, 0)], labels.schema))
    assert common.labelled_sample(docs, both, 100_000, "doc_id", "text", "toxic", 11, 2).count() == 2000


def brute_lexicon(rows):
    """The words that the stated test lets in, from (text, label), with plain counting."""
    toxic, clean = ([t.lower() for t, y in rows if y == v] for v in (1, 0))
    stems = set()
    for text in toxic:
        for word in re.findall(r"[^\W\d_]+", text):
            stems |= {word[:n] for n in range(4, min(len(word), 8) + 1)} | ({word} if not 4 <= len(word) <= 8 else set())
    out = {}
    for stem in stems:
        def holds(text):
            return any((w == stem) if not 4 <= len(stem) <= 8 else w.startswith(stem) for w in re.findall(r"[^\W\d_]+", text))
        t, c = sum(map(holds, toxic)) + 0.5, sum(map(holds, clean)) + 0.5
        if t < 5:
            continue
        weight = math.log(t / (len(toxic) + 1)) - math.log(c / (len(clean) + 1))
        error = math.sqrt(1 / t - 1 / (len(toxic) + 1) + 1 / c - 1 / (len(clean) + 1))
        if weight >= 2 and weight > 3 * error:
            out[stem] = weight
    return out


def test_the_lexicon_by_brute_force(spark, make):
    docs, labels = labelled(make, spark, 400)
    rows = [(f"{r.text} {'zik verylongword' if r.toxic and r.doc_id % 10 == 0 else ''}", r.toxic, r.doc_id)
            for r in docs.join(labels, "doc_id").collect()]
    docs = make([(i, t, "s") for t, _, i in rows])
    model = toxicity.ToxicityModel.fit(docs, labels)
    want = brute_lexicon([(t, y) for t, y, _ in rows])
    assert "zik" in want and "verylongword" in want
    learned = {s: w for s, w in model.lexicon.items() if s not in toxicity.INSULTS}
    assert set(learned) <= set(want) and all(w == pytest.approx(want[s]) for s, w in learned.items())
    for stem in set(want) - set(learned):  # left out only where a shorter one weighs as much
        assert any(model.lexicon.get(stem[:n], 0) >= want[stem] - 0.1 for n in range(4, len(stem)))


def test_short_words_are_no_beginnings():
    lexicon = {"zik": 4.0}
    assert evidence("a zik!", lexicon) > 0 and evidence("a ziko zikzik", lexicon) == 0


def test_the_bar_does_not_move_with_the_table():
    """The same counts of a word are conclusive in a small sample and in one a hundred times as large."""
    import pandas as pd

    for size in (1, 10, 100):
        counts = pd.DataFrame({"stem": ["rare"], "t": [8], "c": [0]})
        assert "rare" in toxicity.weigh(counts, 100 * size, 700 * size)


def test_op3_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in screening.toxic_scores(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r.toxic, got[r.doc_id]) for r in labels if got[r.doc_id].held_out]
    toxic, clean = ([x for t, x in held if t == v] for v in (1, 0))
    assert sum(x.predicted for x in toxic) >= 0.9 * len(toxic)
    assert sum(x.predicted for x in clean) <= 0.005 * len(clean)
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()


def brute_rule(url):
    after = re.search("://([^/?#]*)([^?#]*)", url or "", re.S)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in after[1]) if after else ""
    path = after[2] if after else ""
    fits = [r for r in screening.URL_RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.rule), default=None)
    return host, path, best


URLS = [None, "", "no scheme.com/x", "http://a.com/x?y=1#z", "HTTPS://WWW.Example.COM/en/1", "http://example.com/en/2",
        "http://blog.example.com/en/", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/fr/?q", "http://net/es/",
        "http://x.net/de/1", "http://com", "http://com/", "http://a.com:80/x", "a://b://c.com/d", "http://ü.com/Ä#é", "://x.com/",
        "http://" + "a" * 5000 + ".com/" + "p/" * 5000, "http://x.org/\nq"]


def test_op2_rules_and_trees(spark, small):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = screening.url_filter(spark, small).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule = brute_rule(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.rule)
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")


def test_rules_on_odd_urls(spark):
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(URLS)] + [(None, URLS[3], "x", "y", "z"), (3, URLS[3], "x", "y", "z")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string, label string")
    got = urls.judge(pages, screening.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path, rule = brute_rule(URLS[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule and rule.rule)
    assert urls.judge(pages.limit(0), screening.URL_RULES).count() == 0
    one_class = urls.judge(pages, [urls.UrlRule("block", "com/")]).collect()
    assert {r.verdict for r in one_class} == {"block"}
    none = spark.createDataFrame([], "url string, label double")
    assert {r.verdict for r in urls.judge(pages, [urls.UrlRule("block", "nowhere/")], none).collect()} == {"allow"}


def test_lexical_features(spark):
    url = "https://a-b.shop.example.org/x/y2/?q=1&r=2&&#top"
    r = urls.lexical(spark.createDataFrame([(url,)], "url string"), "url").first()
    counts = Counter(url)
    assert r.entropy == pytest.approx(-sum(n / len(url) * math.log2(n / len(url)) for n in counts.values()))
    assert (r.depth, r.labels, r.parameters, r.hyphens, r.has_fragment, r.secure) == (2, 4, 2, 1, 1, 1)
    assert r.digit_ratio == pytest.approx(3 / len(url)) and (r.suffix_1, r.suffix_2) == ("org", "example.org")


def test_trees_generalise(spark):
    random.seed(4)

    def made(bad):
        host = f"{random.choice('abcdefgh') * 3}{random.randrange(100)}.{random.choice(['info', 'org', 'dev'])}"
        query = "&".join(f"{random.choice('xyz')}{random.randrange(99999)}=1" for _ in range(6)) if bad else ""
        return f"http://{host}/{'/'.join('pq' for _ in range(random.randint(1, 3)))}?{query}", float(bad)

    train, test = ([made(i % 3 == 0) for i in range(n)] for n in (400, 200))
    model = urls.UrlModel(spark.createDataFrame(train, "url string, label double"), trees=5, depth=3)
    scored = model.score(spark.createDataFrame(test, "url string, label double")).collect()
    assert sum((r.block_score > 0.5) == (r.label == 1) for r in scored) >= 190


def test_a_hot_url_is_one_row_of_the_sample(spark, monkeypatch):
    rows = [(f"http://h{i}.org/{'p/' * (i % 5)}", float(i % 3 == 0)) for i in range(60)]
    rows += [("http://hot.org/x", 0.0)] * 500 + [("http://both.org/", 1.0)] * 30 + [("http://both.org/", 0.0)] * 10
    written, cut = {}, urls.cut_lineage
    monkeypatch.setattr(urls, "cut_lineage", lambda df, name: written.setdefault(name, cut(df, name)))
    model = urls.UrlModel(spark.createDataFrame(rows, "url string, label double").repartition(6), trees=2, depth=2)
    sample = {(r.url, r.label): r.copies for r in written["url-sample"].collect()}
    assert sample == {key: float(n) for key, n in Counter(rows).items()} and written["url-sample"].count() == 63
    assert model.base == sum(label for _, label in rows) / len(rows)
    assert [(r.suffix_1, r.n_suffix_1, r.b_suffix_1) for r in written["suffix_1"].collect()] == [("org", 600, 50.0)]
    assert model.trees.getWeightCol() == "copies"


def brute_spans(text):
    text, out = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for kind, pattern, passes in (("assign", assign, lambda m: len(m[2]) >= 6),
                                  ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
                                  ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)):
        out += [(m.start(), n, m.end(), kind) for n in [("assign", "access", "hex").index(kind)]
                for m in pattern.finditer(text) if passes(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


SECRETS = ["token = abcdef", "token=abc", 'xx PassWord: "a.b-c/d+e" end', "api_key=apikey=abcdef1", "token: token: abcdefgh",
           "ſecret=abcdef Koken=abcdef", "AKIA" + "A" * 16, "AKIA" + "B" * 15, "AKIAAKIA" + "C" * 15, "0" * 24 + "g" + "f" * 23,
           "漢字\U0001f600 secret=ÄÖ secret='abcdef' " + "a1" * 12, "deadbeef" * 3 + " token=" + "deadbeef" * 3, "", None, "token=",
           "p" * 100_000, "ab" * 50_000, "passwd" + " " * 50_000 + "=abcdefg", "http://user:pw@host eyJabcdefghi.abcdefghi.abcdefghi",
           "-----BEGIN RSA PRIVATE KEY-----", "token=abcdef\n" * 400]


def test_spans(spark, make):
    docs = make([(i, t, "s") for i, t in enumerate(SECRETS)] + [(i + 100, t, "s") for i, t in enumerate(SECRETS)])
    found, entries = secret_scan.scan_all(docs)
    base = F.filter("findings", lambda s: s["kind"].isin(screening.BASE_KINDS))
    got = {r.path: r for r in found.select("path", secret_scan.joined_spans(base).alias("base"),
                                           secret_scan.joined_spans(F.col("findings")).alias("every")).collect()}
    for i, text in enumerate(SECRETS):
        assert got[i].base == got[i + 100].base == brute_spans(text), text[:50]
    assert "url_login:0:15" in got[18].every and "web_token" in got[18].every and "key_block:0:31" in got[19].every
    assert entries.count() == len({t or "" for t in SECRETS})  # a blob is scanned once


def brute_added(text):
    token = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
    login = re.compile(r"[a-z][a-z0-9+.-]*://[^\x09-\x0D\x20/@:]+:[^\x09-\x0D\x20/@]+@")
    return sorted((m.start(), m.end(), kind) for kind, pattern in (("web_token", token), ("url_login", login))
                  for m in pattern.finditer(text))


def test_added_rules_have_no_upper_bounds(spark, make):
    rng = random.Random(5)
    parts = ["eyJ", "a" * 7, "b-_9" * 3, "C" * 1200, ".", "..", " ", "\n", "@", ":", "://", "/", "postgresql+psycopg2", "oauth2",
             "p" * 300, "x" * 39, "y" * 41, "1", "-", "A", "é\U0001f600", "eyJeyJ"]
    parts += ["eyJ" + "k" * 8 + ".", "." + "l" * 8, "l" * 8 + ".", "://u:", "://" + "m" * 250 + ":", "n" * 250 + "@", "o@"] * 4
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(1500)]
    texts += [f"say eyJ{'h' * 33}.{'P' * 1200}.{'s' * 340} end", f"eyJ{'h' * 1500}.{'P' * 12}.{'s' * 1500}",
              f"https://oauth2:{'t' * 300}@host", f"postgresql+psycopg2://{'u' * 250}:{'w' * 250}@db", "a://u:p@b://u:p@",
              f"{'long-scheme.' * 90}://u:p@h", f"{'z' * 60}://u/ {'z' * 60} x://u:{'é\U0001f600' * 5000}@",
              f"eyJ{'h' * 9}.eyJ{'h' * 9}.{'i' * 9}.{'j' * 9}", "eyJ" * 400 + ".short.", f"http://{'q' * 45}://u:p@"]
    assert sum(len(brute_added(t)) for t in texts) > 150
    found, _ = secret_scan.scan_all(make([(i, t, "s") for i, t in enumerate(texts)]), secret_scan.ADDED_RULES)
    for r in found.collect():
        assert sorted((s.start, s.end, s.kind) for s in r.findings) == brute_added(texts[r.path]), texts[r.path][:200]


def test_long_runs_cost_no_more_than_their_length(spark, make):
    texts = ["ab1" * 1_000_000, "eyJ" * 1_000_000, "a" * 1_000_000 + "://u:p@"]
    found, _ = secret_scan.scan_all(make([(i, t, "s") for i, t in enumerate(texts)]), secret_scan.ADDED_RULES)
    assert {r.path: [(s.start, s.end) for s in r.findings] for r in found.collect()} == {0: [], 1: [], 2: [(0, 1_000_007)]}


def test_many_findings_take_time_in_proportion(spark, make):
    """40,000 findings in one text; a repeated (path, content) row is scanned once."""
    text = "".join(f"é token=abc{i:06d} " for i in range(40_000))
    docs = make([(1, text, "s")] * 3 + [(2, text, "s"), (3, "x", "s")])
    started = time.monotonic()
    found, entries = secret_scan.scan_all(docs)
    rows = found.collect()
    assert time.monotonic() - started < 60
    want = [(m.start(), m.end()) for m in re.finditer(r"token=[a-z0-9]+", text)]
    for r in rows:
        assert [(s.start, s.end) for s in r.findings] == (want if r.path != 3 else [])
    assert len(rows) == 5 and entries.count() == 2


@pytest.mark.parametrize("width", [1, 2, 3, 128])
def test_positions_in_groups(spark, width):
    for n in (0, 1, 2, 5, 9):
        pairs = [("m" * (i % 3 + 1), i * 7 % 5) for i in range(n)]
        df = spark.createDataFrame([(pairs,)], "p array<struct<match:string,gap:bigint>>")
        got = df.select(secret_scan._positions(F.col("p"), width).alias("s")).first().s
        at, want = 0, []
        for match, gap in pairs:
            want.append((at + gap, at + gap + len(match), match))
            at = want[-1][1]
        assert [tuple(x) for x in got] == want


def test_known_contents_stay_where_they_are(spark, make):
    """With a ledger the texts are filtered by a broadcast before any exchange."""
    docs = make([(i, f"password=secret{i}", "s") for i in range(50)])
    _, entries = secret_scan.scan_all(docs)
    more = docs.unionByName(make([(99, "password=another", "s")]))
    seen = []
    original = secret_scan.cut_lineage
    try:
        secret_scan.cut_lineage = lambda df, tag: seen.append((tag, df)) or original(df, tag)
        found, fresh = secret_scan.scan_all(more, ledger=entries)
    finally:
        secret_scan.cut_lineage = original
    plan = dict(seen)["ledger"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and fresh.count() == 1
    assert {r.path: len(r.findings) for r in found.collect()} == {**{i: 1 for i in range(50)}, 99: 1}


def test_the_ledger_saves_scans(spark, make, odd, empty, tmp_path):
    first = make([(1, "token=abcdef", "s"), (2, "plain", "s")])
    _, entries = secret_scan.scan_all(first)
    secret_scan.append(entries, str(tmp_path / "ledger"))
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    second = make([(1, "token=abcdef", "s"), (1, "newer token=ghijkl", "s"), (3, "plain", "s")])
    found, fresh = secret_scan.scan_all(second, ledger=ledger)
    assert [r.blob for r in fresh.collect()] == [hashlib.sha256(b"newer token=ghijkl").hexdigest()]
    assert sorted((r.path, len(r.findings)) for r in found.collect()) == [(1, 1), (1, 1), (3, 0)]
    raised = [secret_scan.Rule("assign", 2, secret_scan.ASSIGN, 4, 2), *secret_scan.BASE_RULES[1:]]
    _, again = secret_scan.scan_all(second, raised, ledger)
    assert {tuple(r.scanned) for r in again.collect() if len(r.scanned) == 1} == {("assign@2",)}  # only the new version
    assert secret_scan.scan_all(odd)[0].count() == odd.count()
    assert secret_scan.scan_all(empty)[0].count() == 0


def test_findings_are_those_of_the_current_versions(spark, make, tmp_path):
    path = str(tmp_path / "ledger")
    texts = ["token=abcdefg token=wxyz", "x token=abcdefg " + "a" * 30]
    docs = make([(i, t, "s") for i, t in enumerate(texts)])

    def rules(version, least, kind="assign"):
        return [secret_scan.Rule(kind, version, secret_scan.ASSIGN, least, 2), *secret_scan.BASE_RULES[1:]]

    def spans(scanned):
        return {r.path: [(s.kind, s.start, s.end) for s in r.findings] for r in scanned.collect()}

    loose = {0: [("assign", 0, 13), ("assign", 14, 24)], 1: [("assign", 2, 15), ("hex", 16, 46)]}
    strict = {0: [("assign", 0, 13)], 1: [("assign", 2, 15), ("hex", 16, 46)]}
    found, entries = secret_scan.scan_all(docs, rules(1, 4))
    secret_scan.append(entries, path)
    assert spans(found) == loose
    found, entries = secret_scan.scan_all(docs, rules(2, 6), spark.read.parquet(path))
    secret_scan.append(entries, path)
    assert spans(found) == strict  # found by both versions: once; found by the withdrawn one alone: gone
    secret_scan.append(entries, path)  # the same scan appended twice
    for current, want in ((rules(2, 6), strict), (rules(1, 4), loose), (rules(3, 8), {0: [], 1: [("hex", 16, 46)]})):
        found, entries = secret_scan.scan_all(docs, current, spark.read.parquet(path))
        assert spans(found) == want
    assert {tuple(r.scanned) for r in entries.collect()} == {("assign@3",)}
    assert spans(secret_scan.scan_all(docs, rules(1, 4)[1:], spark.read.parquet(path))[0]) == {0: [], 1: [("hex", 16, 46)]}


def test_op5_agrees_with_sql(spark, small):
    assert difference(screening.secret_spans(spark, small), duck(small), screening._secrets_sql()) is None


class BruteKneserNey:
    def __init__(self, texts):
        self.uni, self.bi = Counter(), Counter()
        for text in texts:
            before = None
            for w in text:
                self.uni[w] += 1
                self.bi[before, w] += 1
                before = w
        self.before = Counter(w for _, w in self.bi)
        self.d2, self.d1 = self.discounts(self.bi.values()), self.discounts(self.before.values())
        self.opened, self.left = Counter(), Counter()
        for (v, _), c in self.bi.items():
            self.opened[v] += c
            self.left[v] += self.d2[min(c, 3)]
        self.spare = sum(self.d1[min(c, 3)] for c in self.before.values())

    @staticmethod
    def discounts(counts):
        n = [sum(1 for c in counts if c == i) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2])
        return [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]

    def lower(self, w):
        n = self.before[w]
        return (n - self.d1[min(n, 3)]) / len(self.bi) + self.spare / len(self.bi) / (len(self.uni) + 1)

    def p(self, v, w):
        if v not in self.opened:
            return self.lower(w)
        c = self.bi[v, w]
        return (c - self.d2[min(c, 3)] + self.left[v] * self.lower(w)) / self.opened[v]


def test_op4_against_brute_force(spark, small, words, lowered):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    tokens = {r.doc_id: words(lowered(r.text)) + ["</s>"] for r in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    model = BruteKneserNey([t for i, t in tokens.items() if not held[i]])
    n, v = sum(model.uni.values()), len(model.uni)
    assert sum(model.p("the", w) for w in model.uni) + model.p("the", "?unseen") == pytest.approx(1)
    for r in screening.language_model(spark, small).collect():
        text = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(text), n)
        assert r.n_known == sum(w in model.uni for w in text)
        assert r.base_score == pytest.approx(sum(math.log10((model.uni[w] + 1) / (n + v + 1)) for w in text))
        assert r.score == pytest.approx(sum(math.log10(model.p(a, w)) for a, w in zip([None, *text], text)))


def test_model_shards_do_not_matter(spark, odd, monkeypatch):
    whole = kneser_ney.KneserNey.fit(odd)
    want = sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in whole.score(odd).collect())
    monkeypatch.setattr(kneser_ney, "PAIR_TOKENS", 500)
    monkeypatch.setattr(kneser_ney, "VOCABULARY_TOKENS", 700)
    cut = kneser_ney.KneserNey.fit(odd)
    assert cut.numbers["pair_shards"] > 50 and len(cut.numbers["starts"]) > 50
    assert sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in cut.score(odd).collect()) == want


def test_model_of_nothing(spark, odd, empty):
    model = kneser_ney.KneserNey.fit(empty)
    got = model.score(odd).collect()
    assert len(got) == odd.count() and all(r.score == 0 and r.n_known == 0 for r in got)
    assert kneser_ney.KneserNey.fit(odd).score(empty).count() == 0
    assert kneser_ney.KneserNey.fit(odd).score(odd).filter("doc_id = 7").first().n_tokens == 1
    with pytest.raises(ValueError):
        kneser_ney.KneserNey.fit(odd, folder="hdfs://somewhere/model")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(x if x not in b" \t\n\r\x0b\x0c" else 65 for x in b)), max_size=12))
def test_word_hashes_are_those_of_the_library(some):
    data = b" ".join(some) + b" " * 8
    lengths = np.array([len(w) for w in some], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    assert kneser_ney.word_hashes(data, starts, lengths).tolist() == [xxhash.xxh64_intdigest(w) for w in some]


def test_words_that_a_polynomial_takes_for_one(spark, make):
    """Thue-Morse words over a and b and their mirrors agree under any polynomial modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    model = kneser_ney.KneserNey.fit(make([(1, one, "s")]))
    got = {r.doc_id: r.n_known for r in model.score(make([(1, one, "s"), (2, other, "s")])).collect()}
    assert got == {1: 2, 2: 1}


def test_token_hashes(words, lowered):
    texts = ["", " ", "A b\tc", "ab ba aB", "ü Ü", "end "]
    tokens, counts = kneser_ney.token_hashes(texts)
    assert counts.tolist() == [len(words(t)) + 1 for t in texts]
    flat = [w for t in texts for w in [*words(lowered(t)), "</s>"]]
    assert len({*zip(flat, tokens.tolist())}) == len(set(flat)) == len(set(tokens.tolist()))


def brute_class(window):
    counts = Counter(window)
    gone = round(sum(round(c * math.log2(c) * (1 << 20)) for c in counts.values()))
    most = round(fingerprints.WINDOW * math.log2(fingerprints.WINDOW) * (1 << 20))
    return (most - gone) * fingerprints.CLASSES // most


def test_entropy_classes_and_features():
    random.seed(8)
    data = bytes(random.choices(b"abcdefgh     ", k=900)) + b"z" * 100 + bytes(random.choices(range(256), k=500))
    w = fingerprints.WINDOW
    classes = fingerprints.entropy_classes(np.frombuffer(data, dtype=np.uint8))
    assert classes.tolist() == [brute_class(data[i:i + w]) for i in range(len(data) - w + 1)]
    ranks = fingerprints.rarity_ranks(np.bincount(classes, minlength=fingerprints.CLASSES + 1))
    points, span = Counter(), fingerprints.SPAN
    for i in range(len(classes) - span + 1):
        points[min(range(i, i + span), key=lambda j: (ranks[classes[j]], j))] += 1
    want = sorted(p for p, n in points.items() if n >= fingerprints.POINTS and classes[p] >= fingerprints.LEAST_CLASS)
    assert fingerprints.feature_starts(classes, ranks).tolist() == want
    pieces = ["", "a", "b" * 40, data.decode("latin-1"), "tail"]
    together = [c.tolist() for _, c in fingerprints.with_classes(pieces)]
    assert together == [fingerprints.entropy_classes(np.frombuffer(p.encode(), dtype=np.uint8)).tolist() for p in pieces]


def test_op6_against_brute_force(spark, small):
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r.doc_id)
    texts = [r.text for r in docs]
    histogram = sum(np.bincount(c, minlength=fingerprints.CLASSES + 1) for _, c in fingerprints.with_classes(texts))
    digester = fingerprints.Digester(histogram)
    own = digester.digests(texts)
    got = {r.doc_id: r for r in screening.edited_fingerprints(spark, small).collect()}
    assert len(got) == len(docs)
    near, far = [], []
    for k, r in enumerate(docs):
        after, half = (k + 1) % len(docs), len(r.text) // 2
        edited = r.text[:len(r.text) - half] + texts[after][:half]
        changed, mine = digester.digests([edited])[0], got[r.doc_id]
        assert (mine.n_chars, mine.edited_sha256) == (len(r.text), hashlib.sha256(edited.encode()).hexdigest())
        assert (mine.fingerprint, mine.edited_fingerprint) == (fingerprints.to_text(own[k]), fingerprints.to_text(changed))
        assert mine.near_edited == fingerprints.likeness(own[k], changed)
        assert mine.near_next == fingerprints.likeness(own[k], own[after])
        near.append(mine.near_edited)
        far.append(mine.near_next)
    assert np.median(near) > 0.4 and np.median(far) < 0.05


def test_fingerprints_of_odd_rows(spark, odd, empty, tmp_path):
    rows = fingerprints.fingerprint(odd).collect()
    assert len(rows) == odd.count()
    texts = [r.text for r in odd.select("text").distinct().collect() if r.text is None or len(r.text) < 100_000]
    pairs = spark.createDataFrame([(x, y) for x in texts for y in texts], "x string, y string")
    digester = fingerprints.Digester(fingerprints.class_histogram(odd))
    both = pairs.select("x", "y", digester.column(F.col("x")).alias("p"), digester.column(F.col("y")).alias("q"))
    for r in both.withColumn("like", fingerprints.likeness_of("p", "q")).collect():
        assert 0 <= r.like <= 1
        if (r.x or "") == (r.y or ""):
            assert r.p == r.q and r.like == 1
        elif not r.x or not r.y:
            assert r.like == 0
    assert fingerprints.fingerprint(empty).count() == 0
    for name, frame in (("odd", odd), ("one", odd.filter("doc_id = 9")), ("empty", empty)):
        frame.select("doc_id", "text").write.parquet(str(tmp_path / name / "documents.parquet"))
        got = screening.edited_fingerprints(spark, str(tmp_path / name)).collect()
        assert len(got) == frame.count()
    want = []
    order = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd.collect()),
                   key=lambda r: (r[0], r[1], r[2].encode()))
    for k, (_, _, text) in enumerate(order):
        half = len(text) // 2
        want.append(text[:len(text) - half] + order[(k + 1) % len(order)][2][:half])
    got = screening.edited_fingerprints(spark, str(tmp_path / "odd")).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in want)
