"""Cohort dating: sepsis onset date and last-record date per patient.

Inputs are the clinical tables (``subject_id, hadm_id, icd9_code`` for
diagnoses / procedures, ``subject_id, hadm_id, intime`` for ICU stays, and
``subject_id, <time>`` for labs, charts and notes).

Scale notes
-----------
* The dating jobs reduce ICU stays to one row per admission (first day) before
  any join, which cannot change a minimum; their joins are one-row-per-key on
  both sides.  Only ``codes_icu_join`` pairs a code with every stay.
* ``sepsis_date`` needs no join at all: diagnosis, procedure and stay rows are
  projected onto one shape and reduced by one partial (map-side) + final
  aggregate per admission, then one per patient — two shuffles, and a hot
  admission or patient ships one pre-combined row per map task.
* All aggregates here are mergeable (min / max), so AQE may split and coalesce
  partitions freely.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.codes import SEPSIS_CODE_SETS
from cohortlab.functions.expressions import later_of, prefix_flag, prefix_match

ADMISSION = ["subject_id", "hadm_id"]

# criterion -> source table ("diagnoses" or "procedures")
CRITERIA = {
    "infection": "diagnoses",
    "explicit_sepsis": "diagnoses",
    "organ_dysfunction": "diagnoses",
    "mech_vent": "procedures",
}


def with_code_flag(codes: DataFrame, criterion: str, code_col: str = "icd9_code") -> DataFrame:
    """Add the 0/1 ``criterion`` flag of each code row (prefix rule, NULL code -> 0)."""
    return codes.withColumn(criterion, prefix_flag(code_col, SEPSIS_CODE_SETS[criterion]))


def first_icu_time(stays: DataFrame) -> DataFrame:
    """One row per admission: ``subject_id, hadm_id, intime`` = first ICU day."""
    return stays.groupBy(*ADMISSION).agg(F.min(F.try_to_date("intime")).alias("intime"))


def codes_icu_join(codes: DataFrame, stays: DataFrame) -> DataFrame:
    """Every code row with every ICU stay of its admission (inner join on both keys).

    Codes of admissions without an ICU stay drop out.  The result is many-to-many by
    definition; jobs that only need the first day use ``criterion_time``.
    """
    return codes.join(stays.select(*ADMISSION, F.try_to_date("intime").alias("intime")), ADMISSION)


def criterion_time(codes: DataFrame, stays: DataFrame, criterion: str,
                   code_col: str = "icd9_code") -> DataFrame:
    """First ICU day of each admission that has at least one code of ``criterion``.

    Columns: ``subject_id, hadm_id, <criterion> (=1), <criterion>_time``.
    """
    hits = (codes.where(prefix_match(code_col, SEPSIS_CODE_SETS[criterion]))
            .select(*ADMISSION).distinct())
    return (hits.join(first_icu_time(stays), ADMISSION)
            .select(*ADMISSION, F.lit(1).alias(criterion), F.col("intime").alias(f"{criterion}_time")))


def combined_time(first: DataFrame, second: DataFrame, a: str, b: str, out: str = "sep_time") -> DataFrame:
    """Admissions meeting both criteria; time = later of the two criterion times."""
    return (first.join(second, ADMISSION)
            .select(*ADMISSION, later_of(f"{a}_time", f"{b}_time").alias(out)))


def sepsis_date_branches(diagnoses: DataFrame, procedures: DataFrame, stays: DataFrame) -> DataFrame:
    """Sepsis date in the literal three-branch form: explicit ∪ (infection ⋈ organ) ∪ (infection ⋈ vent)."""
    inf = criterion_time(diagnoses, stays, "infection")
    exp = criterion_time(diagnoses, stays, "explicit_sepsis").select(
        *ADMISSION, F.col("explicit_sepsis_time").alias("sep_time"))
    org = criterion_time(diagnoses, stays, "organ_dysfunction")
    ven = criterion_time(procedures, stays, "mech_vent")
    branches = [exp, combined_time(inf, org, "infection", "organ_dysfunction"),
                combined_time(inf, ven, "infection", "mech_vent")]
    return (reduce(DataFrame.unionByName, branches)
            .groupBy("subject_id").agg(F.min("sep_time").alias("sepsis_date")))


def sepsis_date(diagnoses: DataFrame, procedures: DataFrame, stays: DataFrame,
                one_pass: bool = True) -> DataFrame:
    """Earliest sepsis date per patient: ``subject_id, sepsis_date``.

    An admission is septic when it has an explicit severe-sepsis code, or an
    infection code together with an organ-dysfunction code or a ventilation
    procedure.  Its date is the admission's first ICU day (every criterion of
    one admission sees the same stays, so the "later of" two criterion times is
    that day).  ``one_pass=False`` runs the literal three-branch form.
    """
    if not one_pass:
        return sepsis_date_branches(diagnoses, procedures, stays)
    adm = admission_summary(diagnoses, procedures, stays)
    septic = adm.where((F.col("has_stay") == 1) & (
        (F.col("explicit_sepsis") == 1) |
        ((F.col("infection") == 1) & ((F.col("organ_dysfunction") == 1) | (F.col("mech_vent") == 1)))))
    return septic.groupBy("subject_id").agg(F.min("intime").alias("sepsis_date"))


def admission_summary(diagnoses: DataFrame, procedures: DataFrame, stays: DataFrame,
                      code_col: str = "icd9_code") -> DataFrame:
    """One row per admission: the four criterion flags, ``has_stay`` and the first ICU day, without a join.

    Diagnosis rows, procedure rows and stay rows are projected onto one shape
    ``(subject_id, hadm_id, flags…, intime)`` and reduced by a single
    partial/final aggregate keyed by admission (max of flags, min of intime):
    one shuffle of pre-combined rows for all three inputs.  Code rows that hit
    no criterion are dropped before the shuffle.
    """
    crits = list(CRITERIA)
    no_time = F.lit(None).cast("date")

    def code_rows(codes: DataFrame, source: str) -> DataFrame:
        mine = [c for c in crits if CRITERIA[c] == source]
        flags = {c: prefix_flag(code_col, SEPSIS_CODE_SETS[c]) for c in mine}
        any_hit = reduce(lambda x, y: x | y, [prefix_match(code_col, SEPSIS_CODE_SETS[c]) for c in mine])
        return codes.where(any_hit).select(
            *ADMISSION, *[(flags[c] if c in flags else F.lit(0)).alias(c) for c in crits], F.lit(0).alias("has_stay"),
            no_time.alias("intime"))

    stay_rows = stays.select(*ADMISSION, *[F.lit(0).alias(c) for c in crits], F.lit(1).alias("has_stay"),
                             F.try_to_date("intime").alias("intime"))
    rows = reduce(DataFrame.unionByName, [code_rows(diagnoses, "diagnoses"), code_rows(procedures, "procedures"),
                                          stay_rows])
    return rows.groupBy(*ADMISSION).agg(*[F.max(c).alias(c) for c in crits + ["has_stay"]],
                                        F.min("intime").alias("intime"))


# ---------------------------------------------------------------------------
# last record date
# ---------------------------------------------------------------------------

def last_date(events: DataFrame, time_col: str) -> DataFrame:
    """``subject_id, final_date`` = latest calendar day of ``time_col`` per patient."""
    return events.groupBy("subject_id").agg(F.max(F.try_to_date(time_col)).alias("final_date"))


def last_record_date(sources: list[tuple[DataFrame, str]]) -> DataFrame:
    """Latest day over several event tables, in one aggregation.

    The per-table (subject, day) projections are unioned first and reduced by a
    single partial + final max, instead of one aggregate per table followed by
    another over their union.
    """
    days = [df.select("subject_id", F.try_to_date(c).alias("d")) for df, c in sources]
    return (reduce(DataFrame.unionByName, days)
            .groupBy("subject_id").agg(F.max("d").alias("final_date")))


def patient_details(last_dates: DataFrame, sepsis_dates: DataFrame) -> DataFrame:
    """One row per patient seen in either input: ``subject_id, max_date, angus``.

    Sepsis patients are anchored at their sepsis date (``angus`` = 1), every
    other patient at the last day with any record (``angus`` = 0).
    """
    j = last_dates.join(sepsis_dates, "subject_id", "full")
    return j.select("subject_id",
                    F.coalesce("sepsis_date", "final_date").alias("max_date"),
                    F.col("sepsis_date").isNotNull().cast("int").alias("angus"))
