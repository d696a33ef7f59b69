"""Type-2 diabetes phenotype: case (1), control (0) and other (3) patients.

Inputs (clinical column names):

* ``diagnostics``  — ``subject_id, code``
* ``medications``  — ``subject_id, medicine`` (+ ``med_date`` for the date rule)
* ``labs``         — ``subject_id, test_name, value``

Rules, in order:

* T2-diagnosed patients: a diagnosis code in the T2 list and not in the T1 list.
  Medications are only looked at for these patients.
* case 1: T2-diagnosed, no T1 medicine;
  case 2: a T1 medicine and no T2 medicine;
  case 3: both, and the first T1 medicine comes after the first T2 medicine.
* control: at least one normal glucose reading and at least one diagnosis code
  outside the diabetes-related list.  Both tests are per row, so a patient can
  be a case and a control at once (two output rows) unless ``exclusive=True``.
* other: every remaining patient seen in labs, diagnoses or medications.

``phenotype`` (default) reduces all three inputs to one row of facts per
patient in a single aggregation and derives the labels from that row — one
shuffle, pre-combined map-side, so a patient holding a large share of the rows
costs no more than any other.  The rule steps are also available one by one;
there every "patient in / not in list" test is a ``left_semi`` / ``left_anti``
join on distinct keys (never a list collected on the driver).  ``left_anti``
keeps a NULL key, which is what a "not contained" test does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.codes import (DM_DX_RELATED, GLUCOSE_BOUND, GLUCOSE_FASTING_NAMES, GLUCOSE_NAME_MARKERS,
                                       GLUCOSE_PLAIN_NAMES, T1DM_DX, T1DM_MED, T2DM_DX, T2DM_MED, distinct)

ID = "subject_id"


def _ids(df: DataFrame) -> DataFrame:
    return df.select(ID).distinct()


def t2_diagnosis_rows(diagnostics: DataFrame) -> DataFrame:
    """Diagnosis rows with a T2 code that is not a T1 code."""
    code = F.col("code")
    return diagnostics.where(~code.isin(T1DM_DX) & code.isin(T2DM_DX))


def t2_diagnosed(diagnostics: DataFrame) -> DataFrame:
    """Distinct T2-diagnosed patients."""
    return _ids(t2_diagnosis_rows(diagnostics))


def t2_medication(medications: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Medication rows of T2-diagnosed patients (semi join on distinct patient keys)."""
    return medications.join(t2_diagnosed(diagnostics), ID, "left_semi")


def _medicine_in(names: list[str]):
    return F.lower(F.col("medicine")).isin(distinct(names))


def t1_medicine_rows(meds: DataFrame) -> DataFrame:
    return meds.where(_medicine_in(T1DM_MED))


def t2_medicine_rows(meds: DataFrame) -> DataFrame:
    return meds.where(_medicine_in(T2DM_MED))


def case_no_t1_medicine(diagnostics: DataFrame, medications: DataFrame) -> DataFrame:
    """Case 1: T2-diagnosed patients without any T1 medicine."""
    meds = t2_medication(medications, diagnostics)
    return t2_diagnosed(diagnostics).join(_ids(t1_medicine_rows(meds)), ID, "left_anti")


def case_no_t2_medicine(diagnostics: DataFrame, medications: DataFrame) -> DataFrame:
    """Case 2: patients with a T1 medicine and no T2 medicine."""
    meds = t2_medication(medications, diagnostics)
    return _ids(t1_medicine_rows(meds)).join(_ids(t2_medicine_rows(meds)), ID, "left_anti")


def first_medication(diagnostics: DataFrame, medications: DataFrame, restrict: bool = True) -> DataFrame:
    """``subject_id, t1_date, t2_date``: first T1 / T2 medicine day per patient (NULL if none).

    ``restrict=False`` looks at every patient's medicines, not only those of
    T2-diagnosed patients (the other reading of the date rule).
    """
    meds = t2_medication(medications, diagnostics) if restrict else medications
    m = F.lower(F.col("medicine"))
    return (meds.where(m.isin(distinct(T1DM_MED + T2DM_MED)))
            .groupBy(ID)
            .agg(F.min(F.when(m.isin(distinct(T1DM_MED)), F.col("med_date"))).alias("t1_date"),
                 F.min(F.when(m.isin(distinct(T2DM_MED)), F.col("med_date"))).alias("t2_date")))


def case_t2_first(diagnostics: DataFrame, medications: DataFrame, restrict: bool = True) -> DataFrame:
    """Case 3: both medicine types, first T1 day after the first T2 day."""
    fm = first_medication(diagnostics, medications, restrict)
    return fm.where(F.col("t1_date") > F.col("t2_date")).select(ID)


def cases(diagnostics: DataFrame, medications: DataFrame) -> DataFrame:
    parts = [case_no_t1_medicine(diagnostics, medications), case_no_t2_medicine(diagnostics, medications),
             case_t2_first(diagnostics, medications)]
    return reduce(DataFrame.unionByName, parts).distinct()


def _glucose_normal_condition():
    name, v = F.col("test_name"), F.col("value")
    is_glucose = reduce(lambda a, b: a | b, [name.contains(mk) for mk in GLUCOSE_NAME_MARKERS])
    abnormal = ((name.isin(GLUCOSE_FASTING_NAMES) & (v >= GLUCOSE_BOUND)) |
                (name.isin(GLUCOSE_PLAIN_NAMES) & (v > GLUCOSE_BOUND)))
    return is_glucose & ~abnormal


def glucose_normal_rows(labs: DataFrame) -> DataFrame:
    """Glucose lab rows that are not above the bound (one such row qualifies a patient)."""
    return labs.where(_glucose_normal_condition())


def glucose_normal(labs: DataFrame) -> DataFrame:
    return _ids(glucose_normal_rows(labs))


def controls(labs: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Patients with a normal glucose row and a diagnosis outside the diabetes-related codes."""
    code = F.col("code")
    unrelated = diagnostics.where(code.isNull() | ~code.isin(distinct(DM_DX_RELATED)))
    return _ids(unrelated.join(glucose_normal(labs), ID, "left_semi"))


def universe(labs: DataFrame, diagnostics: DataFrame, medications: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [labs.select(ID), diagnostics.select(ID), medications.select(ID)]).distinct()


def patient_summary(medications: DataFrame, labs: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """One row per patient seen anywhere, with every fact the labels need, in one aggregation.

    Diagnosis, medication and lab rows are projected onto one shape and reduced
    by a single partial/final aggregate keyed by patient (max of 0/1 facts, min
    of dates): ``t2_dx, unrelated_dx, has_t1, has_t2, t1_date, t2_date, normal_glucose``.
    """
    code, med = F.col("code"), F.lower(F.col("medicine"))
    zero, no_date = F.lit(0), F.lit(None).cast("date")
    t1, t2 = med.isin(distinct(T1DM_MED)), med.isin(distinct(T2DM_MED))

    def flag(cond):
        return F.when(cond, F.lit(1)).otherwise(zero)

    dx = diagnostics.select(ID, flag(~code.isin(T1DM_DX) & code.isin(T2DM_DX)).alias("t2_dx"),
                            flag(code.isNull() | ~code.isin(distinct(DM_DX_RELATED))).alias("unrelated_dx"),
                            zero.alias("has_t1"), zero.alias("has_t2"), no_date.alias("t1_date"),
                            no_date.alias("t2_date"), zero.alias("normal_glucose"))
    md = medications.select(ID, zero.alias("t2_dx"), zero.alias("unrelated_dx"), flag(t1).alias("has_t1"),
                            flag(t2).alias("has_t2"), F.when(t1, F.col("med_date")).alias("t1_date"),
                            F.when(t2, F.col("med_date")).alias("t2_date"), zero.alias("normal_glucose"))
    lb = labs.select(ID, zero.alias("t2_dx"), zero.alias("unrelated_dx"), zero.alias("has_t1"), zero.alias("has_t2"),
                     no_date.alias("t1_date"), no_date.alias("t2_date"),
                     flag(_glucose_normal_condition()).alias("normal_glucose"))
    rows = reduce(DataFrame.unionByName, [dx, md, lb])
    return rows.groupBy(ID).agg(*[F.max(c).alias(c) for c in ("t2_dx", "unrelated_dx", "has_t1", "has_t2")],
                                F.min("t1_date").alias("t1_date"), F.min("t2_date").alias("t2_date"),
                                F.max("normal_glucose").alias("normal_glucose"))


def phenotype(medications: DataFrame, labs: DataFrame, diagnostics: DataFrame,
              exclusive: bool = False, one_pass: bool = True) -> DataFrame:
    """``subject_id, label``: 1 case, 0 control, 3 other.

    ``one_pass`` (default) labels patients from ``patient_summary`` (one
    shuffle); ``one_pass=False`` runs the rule steps as semi / anti joins.
    """
    if one_pass:
        p = patient_summary(medications, labs, diagnostics)
        t2dx, has1, has2 = F.col("t2_dx") == 1, F.col("has_t1") == 1, F.col("has_t2") == 1
        is_case = t2dx & (~has1 | (has1 & ~has2) | (F.col("t1_date") > F.col("t2_date")))
        is_case = F.coalesce(is_case, F.lit(False))
        is_ctrl = (F.col("normal_glucose") == 1) & (F.col("unrelated_dx") == 1)
        if exclusive:
            is_ctrl = is_ctrl & ~is_case
        labels = F.array_compact(F.array(F.when(is_case, F.lit(1)), F.when(is_ctrl, F.lit(0)),
                                         F.when(~is_case & ~is_ctrl, F.lit(3))))
        return p.select(ID, F.explode(labels).alias("label"))
    case = cases(diagnostics, medications)
    ctrl = controls(labs, diagnostics)
    if exclusive:
        ctrl = ctrl.join(case, ID, "left_anti")
    labelled = case.unionByName(ctrl)
    other = universe(labs, diagnostics, medications).join(labelled, ID, "left_anti")
    return reduce(DataFrame.unionByName, [case.withColumn("label", F.lit(1)), ctrl.withColumn("label", F.lit(0)),
                                          other.withColumn("label", F.lit(3))])
