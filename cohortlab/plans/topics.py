"""Note topic features: bag of words per patient -> online LDA -> 20 topic columns.

Steps (all distributed; the driver only holds the model and the vocabulary):

1. ``note_terms``: (patient, term, n) counts over whole note texts, stop words
   removed — a partial/final aggregate, no per-patient text concatenation.
2. ``vocabulary``: the ``vocab_size`` most frequent terms (distributed top-k).
   It is the one thing brought to the driver, and its size is the
   ``vocab_size`` parameter.
3. ``count_vectors``: the bag joined to the vocabulary (broadcast: at most
   ``vocab_size`` rows) and gathered into one sparse vector per patient.  The
   gather holds at most ``vocab_size`` (index, count) pairs per patient, however
   many notes the patient has.  Patients whose notes have no vocabulary term
   get an empty vector, as a count vectorizer gives them.
4. Online variational topic model (``operators/topic_table.py``): k topics,
   ``max_iter`` mini-batches, symmetric priors 1 / k; the topic-term weights are a
   table, mini-batches are chosen by a hash of the document key, so topics do not
   depend on partitions or shuffle settings.  Then the per-patient topic distribution
   as ``topic_1 .. topic_k``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cohortlab.operators import notes as notes_ops
from cohortlab.operators import topic_table
from cohortlab.session import keep, scratch_dir

NUM_TOPICS = 20
VOCAB_SIZE = 10000
MAX_ITER = 2
MINI_BATCH_ITER_BASE = 100  # the mini-batch fraction is 2 / this + 1 / corpus size
TOP_TERMS = 100
DOC_PARTITIONS = 64  # files of the count vectors


def count_vectors(bag: DataFrame, vocab: DataFrame, doc_keys: DataFrame, size: int,
                  key: str = "subject_id") -> DataFrame:
    """``<key>, features``: sparse term-count vector per document over the vocabulary index.

    The vector's stored form (type 0, size, indices, values) is built from columns,
    written to the shared scratch folder and read back as vectors: no Python per row.
    Rows are partitioned and sorted by the key, so later passes see the same partitions
    whatever the input's were.
    """
    # at most ``vocab_size`` rows
    indexed = bag.join(F.broadcast(vocab.select("term", "idx")), "term")
    per_doc = indexed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", "n"))).alias("entries"))
    docs = doc_keys.join(per_doc, key, "left").withColumn("entries", F.coalesce("entries", F.expr("array()")))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.transform("entries", lambda e: e["idx"].cast("int")).alias("indices"),
                      F.transform("entries", lambda e: e["n"].cast("double")).alias("values"))
    rows = docs.select(key, vector.alias("features")).repartition(DOC_PARTITIONS, key).sortWithinPartitions(key)
    path = scratch_dir(bag.sparkSession, "count-vectors")
    rows.write.parquet(path)
    schema = StructType([docs.schema[key], StructField("features", VectorUDT())])
    return bag.sparkSession.read.schema(schema).parquet(path)


def vector_entries(docs: DataFrame, key: str = "subject_id") -> DataFrame:
    """``<key>, idx, n``: the entries of the count vectors."""
    dense = docs.select(key, F.posexplode(vector_to_array("features")).alias("idx", "v")).where("v > 0")
    return dense.select(key, "idx", F.col("v").cast("long").alias("n"))


def vectors_from_bag(bag: DataFrame, doc_keys: DataFrame, vocab_size: int = VOCAB_SIZE,
                     key: str = "subject_id") -> tuple[DataFrame, DataFrame]:
    """(vocabulary, count vectors) of a (key, term, n) bag; the notes are tokenized once."""
    bag = keep(bag, "bag")
    vocab = keep(notes_ops.vocabulary(bag, vocab_size, key=key), "vocabulary")  # <= vocab_size rows
    n_terms = vocab.count()  # the vector size, as a count vectorizer sets it
    return vocab, count_vectors(bag, vocab, doc_keys, max(n_terms, 1), key)


def mini_batch_fraction(corpus_size: int) -> float:
    return min(1.0, 2.0 / MINI_BATCH_ITER_BASE + 1.0 / max(corpus_size, 1))


@dataclass
class TopicModel:
    """``weights``: topic, idx, weight; ``vocab``: idx, term; ``docs``: entries (key, idx, n); ``keys``: every document's key."""

    weights: DataFrame
    vocab: DataFrame
    docs: DataFrame
    keys: DataFrame
    k: int
    key: str = "subject_id"

    def topic_columns(self) -> DataFrame:
        """``<key>, topic_1 .. topic_k`` (each row sums to 1; an empty document gives all zeros)."""
        dist = topic_table.distributions(self.docs, self.weights, self.k, self.key)
        rows = self.keys.join(dist, self.key, "left")
        return rows.select(self.key, *[F.coalesce(F.col("share")[i], F.lit(0.0)).alias(f"topic_{i + 1}") for i in range(self.k)])

    def topic_terms(self, max_terms: int = TOP_TERMS) -> DataFrame:
        """``topic, rank, term, weight``: the top terms of every topic, rank 1 first."""
        best = Window.partitionBy("topic").orderBy(F.col("weight").desc(), "idx")
        share = F.col("weight") / F.sum("weight").over(Window.partitionBy("topic"))
        ranked = self.weights.select("topic", "idx", share.alias("weight"), F.row_number().over(best).alias("rank")).where(F.col("rank") <= max_terms)
        # at most vocab_size rows
        return ranked.join(F.broadcast(self.vocab.select("idx", "term")), "idx").select("topic", "rank", "term", "weight")


def fit_topics(notes: DataFrame, k: int = NUM_TOPICS, vocab_size: int = VOCAB_SIZE, max_iter: int = MAX_ITER,
               seed: int = 41, key: str = "subject_id") -> TopicModel:
    """Fit the note topic model on one document per ``key`` (notes: ``key, text``)."""
    return fit_topics_from_bag(notes_ops.note_terms(notes, key=key), notes.select(key).distinct(),
                               k, vocab_size, max_iter, seed, key)


def fit_topics_from_bag(bag: DataFrame, doc_keys: DataFrame, k: int = NUM_TOPICS, vocab_size: int = VOCAB_SIZE,
                        max_iter: int = MAX_ITER, seed: int = 41, key: str = "subject_id") -> TopicModel:
    """Fit on a (key, term, n) bag; ``doc_keys`` lists every document (empty ones included)."""
    bag = keep(bag, "bag")
    vocab = keep(notes_ops.vocabulary(bag, vocab_size, key=key), "vocabulary")  # <= vocab_size rows
    docs = keep(bag.join(F.broadcast(vocab.select("term", "idx")), "term").select(key, "idx", "n"), "topic-entries")
    keys = keep(doc_keys, "topic-documents")
    weights = topic_table.fit(docs, vocab.select("idx"), k, keys.count(), max_iter, mini_batch_fraction(keys.count()), seed, key)
    return TopicModel(weights, vocab, docs, keys, k, key)
