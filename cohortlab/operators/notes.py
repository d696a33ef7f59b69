"""Clinical notes: date-bounded notes per patient, concatenation, bag of words, vocabulary.

Scale notes
-----------
* The topic features need each patient's bag of words, not the concatenated
  text: the notes are joined with a space and tokens are runs of letters, so
  tokenizing every note and counting (patient, term) pairs gives the same bag.
  That count is a partial/final aggregate, so a patient with a huge share of
  the notes is reduced map-side before any shuffle.
* ``patient_terms`` joins the notes to the anchor first, so that notes after it are
  neither tokenized nor counted; while the anchor table is under the broadcast threshold no text
  moves, beyond it the join is shuffled and a hot patient's notes are split by AQE.
* ``note_sequence`` keeps one row per (patient, note) with its position;
  ``notes_concat`` joins them to one string per patient only for callers that
  ask for it (a string is bounded by Spark's 2 GB); the topic features never do.
* Top-k per group (``topk_per_group``) is exact and two-stage: a first
  window over (group, salt) keeps the k best of each salted slice, a second
  window over the group sees at most ``salt_buckets * k`` rows.  One group
  holding a third of the rows is spread over ``salt_buckets`` tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.functions.text import STOP_WORDS, tokens
from cohortlab.operators.heavy import top_terms
from cohortlab.operators.running import prefix_sums

ID = "subject_id"


def notes_before_anchor(patients: DataFrame, notes: DataFrame, anchor_col: str = "max_date") -> DataFrame:
    """Notes dated on or before the patient's anchor day (equi-join + range residual).

    Columns: ``subject_id, note_id, chartdate, <anchor_col>, text``.
    """
    p = patients.select(F.col(ID).alias("_pid"), F.col(anchor_col))
    j = notes.join(p, (notes[ID] == p["_pid"]) & (notes["chartdate"] <= p[anchor_col]))
    return j.select(ID, "note_id", "chartdate", anchor_col, "text")


def note_sequence(notes: DataFrame, order=("chartdate", "note_id")) -> DataFrame:
    """``subject_id, position, <order>, text``: one row per note, numbered from 1 in (date, note id) order."""
    place = F.row_number().over(Window.partitionBy(ID).orderBy(*order))
    return notes.where(F.col("text").isNotNull()).select(ID, place.alias("position"), *order, "text")


def notes_concat(notes: DataFrame, order=("chartdate", "note_id")) -> DataFrame:
    """``subject_id, text``: the patient's note texts joined by one space, in (date, note id) order."""
    rows = note_sequence(notes, order)
    ordered = F.array_sort(F.collect_list(F.struct("position", F.col("text").alias("_t"))))
    return rows.groupBy(ID).agg(F.array_join(F.transform(ordered, lambda s: s["_t"]), " ").alias("text"))


def note_chunks(notes: DataFrame, order=("chartdate", "note_id"), chunk_bytes: int = 1 << 20) -> DataFrame:
    """``subject_id, chunk, offset, text``: each patient's joined text in chunks of bounded size, spread over tasks.

    A note lies in the chunk that its first byte falls into; ``offset`` is the chunk's first byte in the text of
    ``notes_concat``, so a chunk holds at most ``chunk_bytes`` and the rest of its last note.  ``order`` must
    tell a patient's notes apart.  Offsets are two-level running sums over the notes' lengths alone; the texts
    move once to their offsets and once to their chunks, whatever share of them one patient has.
    """
    own = notes.where(F.col("text").isNotNull())
    sizes = own.select(ID, *order, (F.octet_length("text") + 1).cast("long").alias("_size"))
    placed = prefix_sums(sizes, [F.col(c) for c in order], {"_upto": F.col("_size")}, [ID])
    placed = placed.select(*[F.col(c).alias(f"_{c}") for c in (ID, *order)], (F.col("_upto") - F.col("_size")).alias("_start"))
    same = reduce(lambda a, b: a & b, [own[c].eqNullSafe(placed[f"_{c}"]) for c in (ID, *order)])
    rows = own.join(placed, same).withColumn("chunk", F.floor(F.col("_start") / chunk_bytes).cast("long"))
    ordered = F.array_sort(F.collect_list(F.struct("_start", F.col("text").alias("_t"))))
    return rows.groupBy(ID, "chunk").agg(F.min("_start").alias("offset"), F.array_join(F.transform(ordered, lambda p: p["_t"]), " ").alias("text"))


def text_of_chunks(chunks: DataFrame) -> DataFrame:
    """``subject_id, text`` of ``notes_concat`` from the chunks, for callers that want one string."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk", F.col("text").alias("_t"))))
    return chunks.groupBy(ID).agg(F.array_join(F.transform(ordered, lambda p: p["_t"]), " ").alias("text"))


def note_terms(notes: DataFrame, key: str = ID, drop_stop_words: bool = True) -> DataFrame:
    """``<key>, term, n``: token counts per key over whole note texts."""
    t = notes.select(key, F.explode(tokens("text")).alias("term"))
    if drop_stop_words:
        t = t.where(~F.col("term").isin(STOP_WORDS))
    return t.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def patient_terms(patients: DataFrame, notes: DataFrame, anchor_col: str = "max_date") -> DataFrame:
    """``subject_id, term, n``: the bag of words of each patient's notes up to the anchor day.

    Equal to ``note_terms(notes_before_anchor(patients, notes))``: the small key side prunes the notes first, so
    only notes up to the anchor are tokenized, and the tokens are counted map-side into (patient, term).
    """
    return note_terms(notes_before_anchor(patients, notes, anchor_col))


def term_stats(bag: DataFrame, key: str = ID) -> DataFrame:
    """``term, term_count, doc_freq`` over a (key, term, n) bag."""
    return bag.groupBy("term").agg(F.sum("n").alias("term_count"), F.count(F.lit(1)).alias("doc_freq"))


def vocabulary(bag: DataFrame, vocab_size: int = 10000, key: str = ID, min_df: int = 1) -> DataFrame:
    """The ``vocab_size`` most frequent terms: ``idx, term, term_count, doc_freq``.

    Order (and ``idx``) is total count descending, then term, so ties at the
    cut are decided by the term and the result is deterministic.  Counts are those of
    certified heavy hitters (``heavy.top_terms``), so the shuffle does not carry every distinct
    term; only the ``vocab_size`` survivors are numbered.
    """
    stats = top_terms(bag, vocab_size, min_df)
    top = stats.orderBy(F.col("term_count").desc(), F.col("term").asc()).limit(vocab_size)
    w = Window.orderBy(F.col("term_count").desc(), F.col("term").asc())
    return top.select((F.row_number().over(w) - 1).cast("int").alias("idx"), "term", "term_count", "doc_freq")


def topk_per_group(df: DataFrame, group, order: list[Column], k: int, salt_col: str,
                   salt_buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """Exact top-``k`` rows per group under a total ``order`` (ties broken by the order itself).

    ``salt_col`` is a column that spreads a group's rows (e.g. the term); the
    first stage ranks inside (group, hash(salt) mod buckets).
    """
    group = [group] if isinstance(group, str) else list(group)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_col), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (stage1.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
            .drop("_salt", "_r1"))
