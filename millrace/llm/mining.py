"""Queries that learn from documents: op11 and op12."""

from pyspark.sql import functions as F

from millrace.llm import collocations, line_quality
from millrace.llm.common import table
from millrace.llm.registry import query

GOOD = 0.3
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_collocations", rf"""
    with p as (select coalesce(lang, 'und') as lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
               from (select lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents)),
    f as (select lang, size, phrase, count(*)::bigint as f from (
            {' union all '.join(
                f"select lang, {k} as size, unnest(list_transform(range(1, len(w) - {k - 2}), "
                f"lambda i: array_to_string(w[i:i + {k - 1}], ' '))) as phrase from p" for k in range(1, 5))})
          group by all having size = 1 or count(*) >= {collocations.LEAST}),
    t as (select lang, sum(f)::bigint as n from f where size = 1 group by lang),
    c as (select lang, size, phrase, f as a, string_split(phrase, ' ') as w from f where size > 1 and f >= {collocations.LEAST}),
    cuts as (select *, unnest(range(1, size)) as k from c),
    s as (select cuts.*, x.f as l, y.f as r, ({collocations.SCALE}::hugeint * a) // (x.f + y.f) as score
          from cuts join f x on x.lang = cuts.lang and x.phrase = array_to_string(w[1:k], ' ')
                    join f y on y.lang = cuts.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
    b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inner_size as (select *, unnest(range(2, size)) as m from c),
    inner_at as (select *, unnest(range(1, size - m + 2)) as i from inner_size),
    hidden as (select distinct c.lang, c.phrase from inner_at o
               join c on c.lang = o.lang and c.phrase = array_to_string(o.w[o.i:o.i + o.m - 1], ' ')
               where 100 * o.a >= {collocations.COVERED} * c.a),
    kept as (select * from b anti join hidden using (lang, phrase))
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n,
           score::bigint as score
    from kept join t using (lang) qualify rank <= {collocations.BEST}""")
def phrases(spark, folder):
    return collocations.collocations(table(spark, folder, "documents")).select(
        F.col("group").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


def _held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


@query("op12_line_quality")
def quality(spark, folder):
    docs = table(spark, folder, "documents")
    model = line_quality.LineQuality.fit(docs, table(spark, folder, "labels").filter(~_held_out()))
    scored = docs.select("doc_id", _held_out().alias("held_out"), model.score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
