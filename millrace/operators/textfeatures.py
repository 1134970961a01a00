"""TF-IDF as joins and aggregations over (document, term) rows."""

from dataclasses import dataclass

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import ngrams, tokens
from millrace.operators.ordered import row_index
from millrace.session import cut_lineage, scratch_path

SMALL_VOCABULARY = 100_000
TEXT_BYTES = 1 << 22  # cleaned text of one partition, whose n-grams take some thirty times as much


def english_stop_words() -> list[str]:
    """Spark's own English list; needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english")


def term_rows(df: DataFrame, key: str, cleaned: Column, stop_words=(), ngram_range=(1, 2)) -> DataFrame:
    """(key, term, tf) of words and n-grams; stop words leave before n-grams are built.

    The texts are shuffled by `key` before they are cut up: they are a fraction
    of the size of their n-grams, and all later grouping by document finds its
    rows in place. Their size sets the number of partitions: by default it would
    follow the size of the texts alone, and what a task holds is their n-grams.
    """
    texts = df.select(key, cleaned.alias("_text"))
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    texts = texts.repartition(max(1, -(-size // TEXT_BYTES)), key)
    words = texts.select(key, tokens(F.col("_text"), stop_words).alias("_words"))
    return (
        words.select(key, F.explode(ngrams(F.col("_words"), *ngram_range)).alias("term"))
        .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    )


def document_terms(terms: DataFrame) -> DataFrame:
    """(term, df, total): documents holding a term and its uses in all of them."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))


def top_terms(terms: DataFrame, k: int = 5000, min_df: int = 2) -> DataFrame:
    """The `k` terms used most among those in at least `min_df` documents, by name on ties.

    Sorted as a top-k: every task keeps k rows at most.
    """
    return document_terms(terms).filter(F.col("df") >= min_df).orderBy(F.desc("total"), "term").limit(k)


def tfidf_weights(df: DataFrame, key: str, cleaned: Column, stop_words=(), ngram_range=(1, 2),
                  min_df: int = 2, max_features: int | None = 5000) -> DataFrame:
    """(key, term, weight): (1 + ln tf) x (ln((1 + n) / (1 + df)) + 1), each document scaled to length 1.

    n counts all documents, also those without terms. The vocabulary is
    broadcast when `max_features` bounds it.
    """
    terms = term_rows(df, key, cleaned, stop_words, ngram_range)
    if max_features is None:
        vocabulary = document_terms(terms).filter(F.col("df") >= min_df)
    else:
        vocabulary = top_terms(terms, max_features, min_df)
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    idf = F.ln((1 + n_docs) / (1 + F.col("df"))) + 1
    weighted = vocabulary.select("term", idf.alias("idf"))
    if max_features is not None and max_features <= SMALL_VOCABULARY:
        known = terms.join(F.broadcast(weighted), "term")
    else:
        known = terms.join(weighted, "term")
    raw = known.select(
        key, "term", ((1 + F.ln("tf")) * F.col("idf")).alias("weight"))
    # a document's terms lie together already, so its length needs no further shuffle
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy(key)))
    return raw.select(key, "term", (F.col("weight") / length).alias("weight"))


@dataclass(frozen=True)
class TfidfModel:
    """A vocabulary with weights learned from training documents, for any other documents.

    `vocabulary` is a table (term, index, idf); terms are numbered in code point order.
    """

    vocabulary: DataFrame
    size: int
    stop_words: tuple = ()
    ngram_range: tuple = (1, 2)

    @classmethod
    def fit(cls, df: DataFrame, key: str, cleaned: Column, stop_words=(), ngram_range=(1, 2), min_df: int = 2,
            max_features: int | None = 5000) -> "TfidfModel":
        terms = term_rows(df, key, cleaned, stop_words, ngram_range)
        chosen = document_terms(terms).filter(F.col("df") >= min_df) if max_features is None else top_terms(
            terms, max_features, min_df)
        n_docs = df.agg(F.count(F.lit(1))).scalar()
        weighted = cut_lineage(chosen.select("term", (F.ln((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf")), "idf")
        numbered = cut_lineage(row_index(weighted, ["term"], "index"), "vocabulary")
        return cls(numbered, numbered.count(), tuple(stop_words), tuple(ngram_range))

    def weights(self, df: DataFrame, key: str, cleaned: Column) -> DataFrame:
        """(key, term, index, weight), each document scaled to length 1; unknown terms are left out."""
        known = F.broadcast(self.vocabulary) if self.size <= SMALL_VOCABULARY else self.vocabulary
        raw = term_rows(df, key, cleaned, self.stop_words, self.ngram_range).join(known, "term").withColumn(
            "weight", (1 + F.ln("tf")) * F.col("idf"))
        length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy(key)))
        return raw.select(key, "term", "index", (F.col("weight") / length).alias("weight"))

    def vectors(self, df: DataFrame, key: str, cleaned: Column, keep=()) -> DataFrame:
        """`key`, `keep` and a sparse vector `features` for every row; a document's terms are one row.

        The rows are written with the layout of a vector and read back as vectors,
        which takes no Python function and spares a fit from redoing the text work.
        """
        spark = df.sparkSession
        entry = F.struct(F.col("index").cast("int").alias("index"), "weight")
        found = self.weights(df, key, cleaned).groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
        empty = F.array().cast("array<struct<index:int,weight:double>>")
        rows = df.select(key, *keep).join(found, key, "left").withColumn("_e", F.coalesce("_e", empty)).select(
            key, *keep, F.struct(
                F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).alias("size"),
                F.transform("_e", lambda e: e["index"]).alias("indices"),
                F.transform("_e", lambda e: e["weight"]).alias("values")).alias("features"))
        path = scratch_path(spark, "vectors")
        rows.write.parquet(path)
        schema = T.StructType([f for f in rows.schema if f.name != "features"] + [T.StructField("features", VectorUDT())])
        return spark.read.schema(schema).parquet(path)

    def save(self, path: str) -> None:
        """Write the vocabulary and the settings as tables under `path`."""
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        settings = [(self.size, list(self.stop_words), list(self.ngram_range))]
        self.vocabulary.sparkSession.createDataFrame(
            settings, "size bigint, stop_words array<string>, ngram_range array<int>").coalesce(1).write.mode(
            "overwrite").json(f"{path}/settings")

    @classmethod
    def load(cls, spark, path: str) -> "TfidfModel":
        row = spark.read.schema("size bigint, stop_words array<string>, ngram_range array<int>").json(
            f"{path}/settings").first()
        return cls(spark.read.parquet(f"{path}/vocabulary"), row["size"], tuple(row["stop_words"] or ()),
                   tuple(row["ngram_range"]))
