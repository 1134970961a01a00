"""The corpus pipeline over `documents`: reject toxic texts, drop exact copies, keep one of each group of
near copies, mix the sources to their target weights, and encode what remains.

Every stage takes all rows its predecessor kept; `run` writes each stage's rows as Parquet in the shared
scratch folder and reads them again, so a lost executor never costs more than its stage.

Defined results, for every stage: a null text counts as the empty one, a null source as a source; null ids lose
against every other id; of rows equal in id and text one stays, of equal texts the row with the smallest
id; ties in the mix go by a digest of the id and the text; very long texts are read whole; an empty table gives
an empty one; further columns of the documents are carried untouched, whatever their names.
"""

from millrace.llm import curation, exact_dedup, mixing, screening, simhash, toxicity
from millrace.session import cut_lineage

# the toxicity model is learned, SimHash's majority and BPE are not SQL: tests hold the stages against brute force
ORACLE_SQL = None


def drop_toxic(spark, docs, sf_dir):
    """Documents that score below the threshold; the model learns from the labelled ones among `docs`."""
    return toxicity.reject(docs, screening.toxicity_model(spark, sf_dir, docs), screening.TOXIC)


def drop_copies(spark, docs, sf_dir):
    """Of texts equal but for white space, the row with the smallest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of texts linked by fingerprints of few differing bits, the row with the smallest id."""
    return simhash.deduplicate(docs, screening.SHINGLE, screening.RADIUS)


def mix_sources(spark, docs, sf_dir):
    """A row for every time that the mix takes a document, whole, laid out in the order of the schedule."""
    return mixing.mix(docs, curation.WEIGHTS, seed=curation.SEED)


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens and digests of the ids and of the bytes they decode to."""
    return curation.token_report(docs, curation.codec(spark))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies),
          ("mixing", mix_sources), ("byte-level BPE", encode)]


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = cut_lineage(docs, f"stage-{number}")
    return docs
