"""Secret scan with an incremental blob ledger, in DataFrame operations only.

* Every version of every path is content-addressed: its blob is the SHA-256 of its bytes.
* A ledger row holds a blob, the rule versions it was scanned with and what they found. A scan takes
  one content per blob that lacks some current rule version and runs only the missing ones on it.
* Findings are joined back to every path that ever held the blob.

A rule is a regular expression searched leftmost and without overlap, a version, and the least length
of a group of the match; matches that fail the length are dropped after the search. Offsets are code
points, end exclusive: the text is split at the matches, and lengths of pieces and matches are added up
in groups, so that the time grows in proportion to the findings of a text.

Contents are moved by (path, blob), once for each, so copies, however many, spread evenly; only the
narrow table (path, blob) is joined by blob, between two written tables, where Spark splits a hot blob.
With a ledger, contents that need no scan stay where they are, unless more than `KNOWN_ROWS` blobs need one.

Defined results: a null content counts as the empty one; null paths and repeated (path, content) rows
give one result row each; an empty table gives no rows; other columns are not read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import key_of, whole_text
from millrace.session import cut_lineage


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0

    @property
    def pair(self) -> str:
        return f"{self.kind}@{self.version}"


# fixed values: the base rules; keywords are spelled out because only A-Z may stand for a-z
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
BASE_RULES = (
    Rule("assign", 1, ASSIGN, least=6, group=2),
    Rule("access", 1, "AKIA[A-Z0-9]+", least=20),
    Rule("hex", 1, "[0-9a-f]{24,}"),  # the runs of [0-9a-f]+ that are long enough
)
# No repeat has an upper bound, and a long run still costs time in proportion to its length: where a run holds
# no secret, no later start in it does either, so the last alternative takes the run whole, without the group
# that a span needs. Scheme runs of up to 40 characters are left to the search instead.
ADDED_RULES = (
    Rule("key_block", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", 2, r"eyJ[A-Za-z0-9_-]{8,}(\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})|eyJ[A-Za-z0-9_-]*", least=1, group=1),
    Rule("url_login", 2, r"[a-z][a-z0-9+.-]*(://[^\x09-\x0D\x20/@:]+:[^\x09-\x0D\x20/@]+@)|[a-z][a-z0-9+.-]{40,}",
         least=1, group=1),
)
PAIRS_TOGETHER = 128
KNOWN_ROWS = 1 << 18  # blobs to scan that may be sent to every task
SPAN = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"
LEDGER = f"blob string, scanned array<string>, findings {SPAN}"


def _bound(value, body):
    """`body` of a value that is worked out once, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _positions(pairs, width: int = PAIRS_TOGETHER):
    """(start, end, match) of (match, gap) pairs: running sums of the lengths of gaps and matches.

    An array can only grow by being copied, so pairs are summed in groups of `width` and the groups shifted."""
    none = F.expr("cast(array() as array<bigint>)")

    def running(lengths):
        """Sums up to and with every length, and the whole sum."""
        grown = F.aggregate(lengths, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("sums")), lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["sums"], F.array(s["at"] + x)).alias("sums")))
        return grown["sums"]

    def placed(pairs):
        groups = F.transform(F.sequence(F.lit(0), F.greatest(F.size(pairs) - 1, F.lit(0)), F.lit(width)),
                             lambda at: F.slice(pairs, at + 1, F.lit(width)))
        local = F.transform(groups, lambda group: F.struct(group.alias("pairs"), running(F.transform(
            group, lambda p: p["gap"] + F.length(p["match"]).cast("bigint"))).alias("ends")))

        def whole(group):
            return F.coalesce(F.try_element_at(group["ends"], F.lit(-1)), F.lit(0).cast("bigint"))

        def shifted(local):
            before = F.zip_with(local, running(F.transform(local, whole)), lambda group, upto: F.struct(
                group.alias("group"), (upto - whole(group)).alias("at")))
            return F.flatten(F.transform(before, lambda b: F.zip_with(
                b["group"]["pairs"], b["group"]["ends"], lambda p, end: F.struct(
                    (b["at"] + end - F.length(p["match"])).alias("start"), (b["at"] + end).alias("end"),
                    p["match"].alias("match")))))
        return _bound(local, shifted)

    return _bound(pairs, placed)


def matches(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans in a text, in order."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda piece: F.length(piece).cast("bigint"))
    paired = F.arrays_zip(found.alias("match"), gaps.alias("gap"))
    known = F.filter(paired, lambda x: x["match"].isNotNull())  # one more piece than matches
    passes = (lambda m: F.length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least) if rule.group else (
        lambda m: F.length(m) >= rule.least)
    spans = F.transform(F.filter(_positions(known), lambda p: passes(p["match"])), lambda p: F.struct(
        p["start"].alias("start"), F.lit(number).alias("kind_no"), p["end"].alias("end"), F.lit(rule.kind).alias("kind")))
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.expr(f"cast(array() as {SPAN})"))


def address(versions: DataFrame, path_col, content_col) -> DataFrame:
    """(path, path_key, blob) of every version: written once, narrow."""
    return cut_lineage(versions.select(F.col(path_col).alias("path"), key_of(path_col).alias("path_key"),
                                       F.sha2(whole_text(content_col), 256).alias("blob")), "blobs")


def scan(versions: DataFrame, addressed: DataFrame, rules, ledger: DataFrame | None = None,
         path_col="doc_id", content_col="text") -> DataFrame:
    """New ledger rows: every (blob, rule version) pair of `versions` that `ledger` does not have."""
    rules = list(rules)
    pairs = F.array(*[F.lit(rule.pair) for rule in rules])
    holders = addressed.groupBy("blob").agg(F.min("path_key").alias("path_key"))
    if ledger is None:
        unseen = holders.withColumn("missing", pairs)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
        unseen = holders.join(seen, "blob", "left").withColumn(
            "missing", F.array_except(pairs, F.coalesce("seen", F.expr("cast(array() as array<string>)")))
        ).filter(F.size("missing") > 0).drop("seen")
    contents = versions.select(key_of(path_col).alias("path_key"), whole_text(content_col).alias("content")).withColumn(
        "blob", F.sha2("content", 256))
    if ledger is not None:
        unseen = cut_lineage(unseen, "unseen")
        if unseen.count() <= KNOWN_ROWS:  # the contents that the ledger knows are not moved at all
            contents = contents.join(F.broadcast(unseen.select("path_key", "blob")), ["path_key", "blob"], "left_semi")
    # a path may hold a blob many times: one of these rows is kept, before the contents are moved
    one = contents.dropDuplicates(["path_key", "blob"]).join(unseen.hint("shuffle_hash"), ["path_key", "blob"])
    none = F.expr(f"cast(array() as {SPAN})")
    found = [F.when(F.array_contains("missing", rule.pair), matches(F.col("content"), rule, number)).otherwise(none)
             for number, rule in enumerate(rules)]
    scanned = one.select("blob", F.col("missing").alias("scanned"), F.array_sort(F.concat(*found)).alias("findings"))
    return cut_lineage(scanned, "ledger")


def append(entries: DataFrame, ledger_path: str) -> None:
    """Add new ledger rows to the ledger at `ledger_path`."""
    entries.write.mode("append").parquet(ledger_path)


def findings(addressed: DataFrame, ledger: DataFrame, rules) -> DataFrame:
    """One row per version: path, blob, findings of the current rules ordered by start and rule.

    `ledger` holds one row per blob and scan. A row's spans of a kind were found by the version of that kind
    in its `scanned`; they count only if that version is current, and once however many rows hold them.
    Spans are renumbered by the current order of rules.
    """
    current = F.create_map(*[F.lit(x) for n, rule in enumerate(rules) for x in (rule.kind, n)])
    pairs = F.create_map(*[F.lit(x) for rule in rules for x in (rule.kind, rule.pair)])
    valid = F.filter("findings", lambda s: F.coalesce(
        F.array_contains("scanned", F.element_at(pairs, s["kind"])), F.lit(False)))
    renumbered = F.array_sort(F.transform(F.flatten(F.collect_list("valid")), lambda s: F.struct(
        s["start"].alias("start"), F.element_at(current, s["kind"]).alias("kind_no"), s["end"].alias("end"),
        s["kind"].alias("kind"))))
    # equal spans stand side by side now
    ordered = _bound(renumbered, lambda spans: F.filter(
        spans, lambda s, i: (i == 0) | (s != F.get(spans, F.greatest(i - 1, F.lit(0))))))
    kept = ledger.filter(F.size("findings") > 0).select("blob", valid.alias("valid"))
    hits = kept.groupBy("blob").agg(ordered.alias("findings"))
    none = F.expr(f"cast(array() as {SPAN})")
    return addressed.join(cut_lineage(hits, "findings"), "blob", "left").select(
        "path", "blob", F.coalesce("findings", none).alias("findings"))


def scan_all(versions: DataFrame, rules=BASE_RULES + ADDED_RULES, ledger: DataFrame | None = None,
             path_col="doc_id", content_col="text") -> tuple[DataFrame, DataFrame]:
    """(findings of every version, new ledger rows)."""
    addressed = address(versions, path_col, content_col)
    entries = scan(versions, addressed, rules, ledger, path_col, content_col)
    whole = entries if ledger is None else entries.unionByName(ledger.select(*entries.columns))
    return findings(addressed, whole, rules), entries


def joined_spans(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
