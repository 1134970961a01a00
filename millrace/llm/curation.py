"""Queries that choose, order, encode and attest documents: op7 to op10 and op13."""

from pyspark.sql import functions as F

from millrace.llm import exact_dedup, merkle, mixing, sharding, tokens
from millrace.llm.common import lower_ascii, table
from millrace.llm.registry import query

RANKS = "byte_bpe_50k.tiktoken"
WEIGHTS = (3, 1, 2)
SEED = 7

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def codec(spark):
    import public_tokenizers

    return tokens.Codec(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def token_report(docs, coder):
    return docs.select("doc_id", coder.round_trip("text").alias("coded")).select("doc_id", "coded.*")


@query("op7_byte_bpe")
def byte_bpe(spark, folder):
    return token_report(table(spark, folder, "documents"), codec(spark))


def _crc_entry(number):
    for _ in range(8):
        number = number >> 1 ^ (0xEDB88320 if number & 1 else 0)
    return number


# DuckDB has no CRC-32: a byte at a time over the text's hexadecimal form, with the usual table of 256 steps as text
_CRC32 = """xor(list_reduce([4294967295::bigint] || list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::bigint),
    lambda a, b: xor(a >> 8, ('0x' || substr('""" + "".join(f"{_crc_entry(i):08x}" for i in range(256)) + """',
      8 * (xor(a, b) & 255) + 1, 8))::bigint)), 4294967295)"""


@query("op8_sharding", f"""
    with d as (select doc_id, case when source is null then '0' else '1' || source end as stratum,
                      (strlen(coalesce(text, '')) + 1)::bigint as size, {_CRC32} as text_crc32,
                      md5('{SEED}:' || coalesce(doc_id::varchar, '')) as digest from documents),
    r as (select *, row_number() over (partition by stratum order by digest, doc_id, text_crc32, size) - 1 as place,
                 count(*) over (partition by stratum) as n from d),
    o as (select *, row_number() over (order by (2 * place + 1) / (2 * n), stratum, digest, doc_id, text_crc32, size) - 1 as p,
                 count(*) over () as total from r)
    select doc_id, size, text_crc32, 'rows' as law, p * 16 // total as shard,
           p - ((p * 16 // total) * total + 15) // 16 as slot, null::integer as grown_shard from o""")
def shards(spark, folder):
    assigned = sharding.assign_shards(table(spark, folder, "documents"), 16, SEED)
    return assigned.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                           F.lit(None).cast("int").alias("grown_shard"))


@query("op9_exact_dedup", rf"""
    with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
               from documents),
    g as (select *, min(doc_id) over (partition by text_sha256) as keep_id,
                 count(*) over (partition by text_sha256) as group_size from d)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g""")
def exact_duplicates(spark, folder):
    return exact_dedup.decisions(table(spark, folder, "documents")).withColumnRenamed("digest", "text_sha256")


@query("op10_mixing", rf"""
    with d as (select doc_id, source, {_WORDS} as size, md5('{SEED}:' || doc_id) as digest from documents),
    s as (select source, sum(size)::bigint as source_size from d group by source),
    w as (select *, list_value({', '.join(map(str, WEIGHTS))})[1 + (row_number() over (
              order by source nulls last) - 1) % {len(WEIGHTS)}] as weight from s),
    l as (select *, 2 * source_size as full_words, 2 * source_size / weight::double as lim from w),
    f as (select *, (1.5::double * (sum(source_size) over ())::double - (coalesce(sum(full_words) over b, 0))::double)
              / ((sum(weight) over ()) - coalesce(sum(weight) over b, 0))::double as water
          from l window b as (order by lim, source nulls last rows between unbounded preceding and 1 preceding)),
    v as (select (select f.water from f where f.water <= f.lim order by f.lim, f.source nulls last limit 1) as level),
    t as (select source, source_size, case when level < lim then weight * level else full_words::double end as target
          from f, v),
    r as (select d.doc_id, d.size, t.source_size, t.target, floor(t.target)::bigint as words,
                 coalesce(sum(d.size) over (partition by d.source order by d.digest, d.doc_id
                     rows between unbounded preceding and 1 preceding), 0)::bigint as earlier
          from d join t on d.source is not distinct from t.source)
    select doc_id, size, source_size, target, (case when size > 0 and 2 * words >= 2 * earlier + size
             then size * least(2, (2 * words - 2 * earlier - size) // (2 * source_size) + 1) else 0 end)::bigint as taken
    from r""")
def mixed(spark, folder):
    return mixing.mix_plan(table(spark, folder, "documents"), WEIGHTS, seed=SEED).drop("first_slot")


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _written_sql(field, value=None):
    value = value or f"{field}::varchar"
    return f"case when {field} is null then '-' else strlen({value}) || ':' || {value} end"


_LEAF = "sha256(" + " || ".join(_written_sql(f) for f in LEAF_FIELDS) + ")"
_TAMPERED = "sha256(" + " || ".join(_written_sql(f, "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
                                  if f == "text" else _written_sql(f) for f in LEAF_FIELDS) + ")"


def _tree_sql(name, leaves):
    """Nodes of all trees level by level, and per level the runs of eight under one parent."""
    return f"""
    {name}_nodes(tree, level, idx, digest) as (
      select tree, 0::bigint, idx, digest from {leaves}
      union all
      select tree, level + 1, idx // 8, sha256(string_agg(digest, '' order by idx))
      from (select *, count(*) over (partition by tree) as width from {name}_nodes) where width > 1 group by tree, level, idx // 8),
    {name}_runs as (
      select tree, level, idx // 8 as parent, list(digest order by idx) as run
      from (select *, count(*) over (partition by tree, level) as width from {name}_nodes) where width > 1 group by tree, level, idx // 8),
    {name}_tops as (select tree, max(level) as height, arg_max(digest, level) as top from {name}_nodes group by tree)"""


def _walk_sql(name, starts):
    """What a claim folds to on its way up, with the siblings it meets."""
    return f"""
    {name}_walk(row_no, tree, level, place, folded, proof) as (
      select row_no, tree, 0::bigint, place, folded, proof from {starts}
      union all
      select w.row_no, w.tree, w.level + 1, w.place // 8,
             sha256(array_to_string(run[1:w.place % 8], '') || w.folded || array_to_string(run[w.place % 8 + 2:], '')),
             w.proof || array_to_string(run[1:w.place % 8], '') || array_to_string(run[w.place % 8 + 2:], '')
      from {name}_walk w join {name}_runs r on r.tree = w.tree and r.level = w.level and r.parent = w.place // 8)"""


@query("op13_merkle", f"""
    with recursive d as (
      select doc_id, lang, {_LEAF} as leaf, case when ({_CRC32.replace('text', 'doc_id::varchar')}) % 3 = 0 and doc_id is not null
             then {_TAMPERED} else {_LEAF} end as claim from documents),
    o as (select *, row_number() over () as row_no, dense_rank() over (order by lang nulls first) - 1 as tree,
                 row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx from d),
    leaves as (select tree, idx, leaf as digest from o),{_tree_sql('lang', 'leaves')},
    subroots as (select 0::bigint as tree, tree as idx, top as digest from lang_tops),{_tree_sql('all', 'subroots')},
    begun as (select row_no, tree, idx as place, claim as folded, '' as proof from o),{_walk_sql('lang', 'begun')},
    half as (select w.row_no, 0::bigint as tree, w.tree as place, w.folded, w.proof from lang_walk w join lang_tops t
             on t.tree = w.tree and t.height = w.level),{_walk_sql('all', 'half')}
    select o.doc_id, o.leaf, s.top as subroot, a.top as root, sha256(w.proof) as proof_sha256, w.folded as folded_root,
           w.folded = a.top as verified
    from all_walk w join all_tops a on a.height = w.level join o on o.row_no = w.row_no join lang_tops s on s.tree = o.tree""")
def manifest_proofs(spark, folder):
    docs = table(spark, folder, "documents")
    tampered = [lower_ascii(F.col(f)) if f == "text" else F.col(f) for f in LEAF_FIELDS]
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    true, lowered = merkle.leaf_digest([F.col(f) for f in LEAF_FIELDS]), merkle.leaf_digest(tampered)
    made = merkle.Manifest.build(docs, LEAF_FIELDS, claim=F.when(changed, lowered).otherwise(true))
    root = F.lit(made.root).cast("string")
    return made.proofs().select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                                (F.col("folded_root") == root).alias("verified"))
