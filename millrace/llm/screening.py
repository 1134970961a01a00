"""Queries that judge, score or compare documents and pages: op1 to op6."""

import hashlib

import pandas as pd
from pyspark.sql import functions as F

from millrace.llm import fingerprints, secret_scan, simhash, toxicity, urls
from millrace.llm.common import shuffle_partitions, table, whole_text
from millrace.llm.kneser_ney import KneserNey
from millrace.llm.registry import query
from millrace.operators.balance import bucket_by, split_points
from millrace.session import cut_lineage

SHINGLE, RADIUS = 3, 2
URL_RULES = (urls.UrlRule("allow", "com/"), urls.UrlRule("block", "example.com/en/"),
             urls.UrlRule("allow", "www.example.com/en/"), urls.UrlRule("block", "net/es/"),
             urls.UrlRule("block", "net/fr/"))
TOXIC = 0.7
BASE_KINDS = [rule.kind for rule in secret_scan.BASE_RULES]


def id_remainder(divisor, column="doc_id"):
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(divisor))


@query("op1_simhash")
def simhash_components(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"), SHINGLE, RADIUS).drop("kept")


@query("op2_url_filter")
def url_filter(spark, folder):
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


def toxicity_model(spark, folder, docs):
    labels = table(spark, folder, "labels").filter(id_remainder(3) != 1)
    return toxicity.ToxicityModel.fit(docs, labels)


@query("op3_toxicity")
def toxic_scores(spark, folder):
    docs = table(spark, folder, "documents")
    scored = docs.select("doc_id", F.coalesce(id_remainder(3) == 1, F.lit(False)).alias("held_out"),
                         toxicity_model(spark, folder, docs).score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


@query("op4_kneser_ney")
def language_model(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(id_remainder(7) == 2, F.lit(False))
    model = KneserNey.fit(docs.filter(~held_out))
    return model.score(docs, "doc_id", "text", held_out.alias("held_out")).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.numbers["tokens"]).cast("bigint").alias("train_tokens"),
        F.col("unigram_score").alias("base_score"), "score")


def _spans_sql(rule, number, text="coalesce(text, '')"):
    pattern = rule.pattern.replace("'", "''")
    checked = f"length(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.least}"
    return f"""
    p{number} as (select doc_id, n, regexp_extract_all({text}, '{pattern}') as m,
                         [length(x) for x in string_split_regex({text}, '{pattern}')] as g from t),
    f{number} as (select doc_id, n, i, m, list_sum(g[1:i]) + coalesce(list_sum([length(x) for x in m[1:i-1]]), 0) as s
                  from (select doc_id, n, m, g, unnest(range(1, len(m) + 1)) as i from p{number})),
    k{number} as (select doc_id, n, {number} as kind_no, s::bigint as s, (s + length(m[i]))::bigint as e,
                         '{rule.kind}' as kind from f{number} where {checked})"""


def _secrets_sql():
    rules = secret_scan.BASE_RULES + secret_scan.ADDED_RULES
    base = ", ".join(f"'{kind}'" for kind in BASE_KINDS)
    counts = ", ".join(f"count(*) filter (kind = '{kind}') as n_{kind}" for kind in BASE_KINDS)
    spans = "string_agg(kind || ':' || s || ':' || e, ',' order by s, kind_no{})"
    return f"""
    with t as (select doc_id, text, row_number() over () as n from documents),{','.join(map(_spans_sql, rules, range(len(rules))))},
    a as ({' union all '.join(f'from k{i}' for i in range(len(rules)))}),
    r as (select t.doc_id, t.n, {counts},
                 sha256(coalesce({spans.format(', e')} filter (kind in ({base})), '')) as base_sha256,
                 coalesce({spans.format(', e')}, '') as spans
          from t left join a on t.n = a.n group by all)
    select * exclude (n) from r"""


@query("op5_secret_scan", _secrets_sql())
def secret_spans(spark, folder):
    found, _ = secret_scan.scan_all(table(spark, folder, "documents"))

    def of(*kinds):
        return F.filter("findings", lambda s: s["kind"].isin(*kinds))

    base = of(*BASE_KINDS)
    return found.select(
        F.col("path").alias("doc_id"),
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(secret_scan.joined_spans(base), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("findings")).alias("spans"))


_SLICE = 1 << 20  # characters of text compared together


def _compare_with_next(digester):
    """Digest columns of every row of a stream of rows ordered by bucket; the row after a row in its
    bucket is its next one, and a bucket's last row is only there to be the next one."""
    def compared(group, following):
        """Results of the rows of `group`, a list of (doc_id, text), whose last next row is `following`."""
        texts = [text for _, text in group] + [following]
        digests = digester.digests(texts)
        edited = []
        for (_, text), after in zip(group, texts[1:]):
            moved = len(text) // 2
            edited.append(text[:len(text) - moved] + after[:moved])
        for (doc_id, text), changed, own, after, other in zip(group, edited, digests, digests[1:], digester.digests(edited)):
            yield (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.to_text(own),
                   fingerprints.to_text(other), fingerprints.likeness(own, other), fingerprints.likeness(own, after))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        waiting, size, out = [], 0, []
        for batch in batches:
            for only_next, doc_id, text in zip(batch["only_next"], batch["doc_id"], batch["text"]):
                if waiting and (only_next or size >= _SLICE):
                    out.extend(compared(waiting, text))
                    waiting, size = [], 0
                if not only_next:  # such rows end their bucket
                    waiting.append((doc_id, text))
                    size += len(text)
                if len(out) >= 1024:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        if waiting:
            raise RuntimeError("a bucket came without the first row of the next one")
        yield pd.DataFrame(out, columns=names)

    return run


@query("op6_fingerprints")
def edited_fingerprints(spark, folder):
    """Texts go to buckets of neighbouring ids, each with a copy of the next bucket's first row, so one
    shuffle of the texts pairs every document with its next one; null ids come first, equal ids by text."""
    docs = table(spark, folder, "documents").select("doc_id", whole_text("text").alias("text"))
    digester = fingerprints.Digester(fingerprints.class_histogram(docs))
    buckets = 1 << (4 * shuffle_partitions(docs) - 1).bit_length()
    # approximate quantiles may differ from one run to the next, so they are written: both uses must agree
    splits = cut_lineage(docs.agg(split_points(F.col("doc_id"), buckets).alias("splits")), "id-splits").scalar()
    placed = bucket_by(docs, F.col("doc_id"), splits, "bucket", buckets)
    # one row per bucket
    firsts = bucket_by(docs.select("doc_id"), F.col("doc_id"), splits, "bucket", buckets).groupBy("bucket").agg(
        F.min(F.struct("doc_id")).alias("first"))
    rows = sorted(firsts.collect(), key=lambda r: r["bucket"])
    before = {row["bucket"]: rows[i - 1]["bucket"] for i, row in enumerate(rows)}
    shown = spark.createDataFrame([(r["bucket"], r["first"]["doc_id"], before[r["bucket"]]) for r in rows],
                                  "of int, first bigint, before int")
    met = placed.join(F.broadcast(shown), (placed.bucket == shown.of) & placed.doc_id.eqNullSafe(shown["first"]), "left")
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("only_next"))
    there = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("only_next"))
    sent = met.select("doc_id", "text", F.explode(F.when(F.col("of").isNull(), F.array(here)).otherwise(
        F.array(here, there))).alias("to")).select("to.bucket", "to.only_next", "doc_id", "text")
    ordered = sent.repartition(shuffle_partitions(docs), "bucket").sortWithinPartitions(
        "bucket", "only_next", "doc_id", "text")
    # ids travel as text: pandas would turn integers beside nulls into floating-point numbers
    return ordered.select("only_next", F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        _compare_with_next(digester), "doc_id string, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double").withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))
