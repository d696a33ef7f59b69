"""Registered queries: notes before the anchor, concatenation, tokens, stop words, vocabulary, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions.text import STOP_WORDS, tokens, without_stop_words
from cohortlab.operators import notes
from cohortlab.plans import q_cohort
from cohortlab.plans.catalog import ORACLES, register
from cohortlab.sources.tables import Clinical, with_views

VOCAB_SIZE = 10000
TOP_K = 100

_STOP_SQL = ",".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
_TOK_SQL = r"regexp_extract_all(lower(text), '\p{L}+')"
_NOTES_SQL = ("SELECT n.subject_id, n.note_id, n.chartdate, p.max_date, n.text FROM noteevents n JOIN patient_anchor p "
              "ON n.subject_id = p.subject_id AND n.chartdate <= p.max_date")
_BAG_SQL = (f"SELECT subject_id, term, count(*) AS n FROM (SELECT subject_id, unnest({_TOK_SQL}) AS term "
            f"FROM ({_NOTES_SQL}) x) t WHERE term NOT IN ({_STOP_SQL}) GROUP BY subject_id, term")


def _notes(spark, d):
    c = Clinical(spark, d)
    return notes.notes_before_anchor(c.patient_anchor, c.noteevents)


@register("notes_before_anchor", with_views(_NOTES_SQL, "noteevents", "patient_anchor"))
def notes_before_anchor(spark, d):
    return _notes(spark, d)


@register("notes_concat", with_views(
    f"SELECT subject_id, string_agg(text, ' ' ORDER BY chartdate, note_id) AS text FROM ({_NOTES_SQL}) x "
    f"WHERE text IS NOT NULL GROUP BY subject_id", "noteevents", "patient_anchor"))
def notes_concat(spark, d):
    return notes.notes_concat(_notes(spark, d))


CHUNK_BYTES = 16_384
_STARTS_SQL = (f"SELECT subject_id, chartdate, note_id, text, sum(strlen(text) + 1) OVER (PARTITION BY subject_id ORDER BY chartdate, note_id "
               f"ROWS UNBOUNDED PRECEDING) - strlen(text) - 1 AS start FROM ({_NOTES_SQL}) x WHERE text IS NOT NULL")


@register("note_chunks", with_views(
    f"SELECT subject_id, cast(start // {CHUNK_BYTES} AS BIGINT) AS chunk, cast(min(start) AS BIGINT) AS offset, "
    f"string_agg(text, ' ' ORDER BY chartdate, note_id) AS text FROM ({_STARTS_SQL}) s GROUP BY 1, 2", "noteevents", "patient_anchor"))
def note_chunks(spark, d):
    """Each patient's joined text as chunks of bounded size."""
    return notes.note_chunks(_notes(spark, d), chunk_bytes=CHUNK_BYTES)


@register("notes_concat_chunked", ORACLES["notes_concat"])
def notes_concat_chunked(spark, d):
    """The joined text rebuilt from the chunks."""
    return notes.text_of_chunks(notes.note_chunks(_notes(spark, d), chunk_bytes=CHUNK_BYTES))


@register("tokenize", f"SELECT doc_id, pos, term FROM (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) - 1 AS pos "
                      f"FROM (SELECT doc_id, {_TOK_SQL} AS toks FROM documents) t) u")
def tokenize(spark, d):
    """One row per token of every document, with its position."""
    docs = Clinical(spark, d).raw("documents").select("doc_id", tokens("text").alias("tok"))
    return docs.select("doc_id", F.posexplode("tok").alias("pos", "term")).select("doc_id", F.col("pos").cast("long").alias("pos"), "term")


@register("stopword_filter", f"SELECT doc_id, array_to_string(list_filter({_TOK_SQL}, lambda w: w NOT IN ({_STOP_SQL})), ' ') AS kept "
                             f"FROM documents")
def stopword_filter(spark, d):
    """The tokens that stay, in order, joined by a blank."""
    docs = Clinical(spark, d).raw("documents").select("doc_id", tokens("text").alias("tok"))
    return docs.select("doc_id", F.array_join(without_stop_words("tok"), " ").alias("kept"))


@register("note_terms", with_views(_BAG_SQL, "noteevents", "patient_anchor"))
def note_terms(spark, d):
    c = Clinical(spark, d)
    return notes.patient_terms(c.patient_anchor, c.noteevents)


@register("vocabulary", with_views(
    f"SELECT cast(row_number() OVER (ORDER BY term_count DESC, term) - 1 AS INTEGER) AS idx, term, term_count, doc_freq "
    f"FROM (SELECT term, cast(sum(n) AS BIGINT) AS term_count, count(*) AS doc_freq FROM ({_BAG_SQL}) b GROUP BY term) s "
    f"QUALIFY row_number() OVER (ORDER BY term_count DESC, term) <= {VOCAB_SIZE}", "noteevents", "patient_anchor"))
def vocabulary(spark, d):
    c = Clinical(spark, d)
    return notes.vocabulary(notes.patient_terms(c.patient_anchor, c.noteevents), VOCAB_SIZE)


@register("topk_per_group", (
    f"SELECT lang, term, n, cast(rank AS INTEGER) AS rank FROM (SELECT lang, term, n, row_number() OVER "
    f"(PARTITION BY lang ORDER BY n DESC, term) AS rank FROM (SELECT lang, term, count(*) AS n FROM "
    f"(SELECT lang, unnest({_TOK_SQL}) AS term FROM documents) t WHERE term NOT IN ({_STOP_SQL}) "
    f"GROUP BY lang, term) c) r WHERE rank <= {TOP_K}"))
def topk_per_group(spark, d):
    docs = Clinical(spark, d).raw("documents").select("lang", "text")
    counts = notes.note_terms(docs, key="lang")
    return notes.topk_per_group(counts, "lang", [F.col("n").desc(), F.col("term").asc()], TOP_K, salt_col="term")\
        .select("lang", "term", "n", F.col("rank").cast("int").alias("rank"))


_VECTORS_SQL = (f"SELECT b.subject_id, v.idx, b.n FROM ({_BAG_SQL}) b JOIN (SELECT cast(row_number() OVER (ORDER BY term_count DESC, term) - 1 "
                f"AS INTEGER) AS idx, term FROM (SELECT term, sum(n) AS term_count FROM ({_BAG_SQL}) x GROUP BY term) s "
                f"QUALIFY row_number() OVER (ORDER BY term_count DESC, term) <= {VOCAB_SIZE}) v USING (term)")


@register("count_vectors", with_views(_VECTORS_SQL, "noteevents", "patient_anchor"))
def count_vectors(spark, d):
    """Entries of the count vectors, read back out of the vectors."""
    from cohortlab.plans import topics
    c = Clinical(spark, d)
    bag = notes.patient_terms(c.patient_anchor, c.noteevents)
    _, docs = topics.vectors_from_bag(bag, _notes(spark, d).select("subject_id").distinct(), VOCAB_SIZE)
    return topics.vector_entries(docs)


#: The patients of the details lived thirty years before the notes; their notes are those of the same day of the month then.
_EARLIER_DAYS = 10_957


@register("note_terms_from_details", q_cohort.with_details(_BAG_SQL.replace(
    "noteevents n", f"(SELECT subject_id, note_id, cast(chartdate - {_EARLIER_DAYS} AS DATE) AS chartdate, text FROM noteevents) n")))
def note_terms_from_details(spark, d):
    """The chained job: dates, patient details, bag of words."""
    earlier = Clinical(spark, d).noteevents.withColumn("chartdate", F.date_sub("chartdate", _EARLIER_DAYS))
    return notes.patient_terms(q_cohort.patient_details(spark, d), earlier)
