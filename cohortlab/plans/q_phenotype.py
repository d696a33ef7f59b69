"""Registered queries: diabetes phenotype steps and labels."""

from __future__ import annotations

from cohortlab.functions.codes import (DM_DX_RELATED, GLUCOSE_BOUND, GLUCOSE_FASTING_NAMES, GLUCOSE_PLAIN_NAMES,
                                       T1DM_DX, T1DM_MED, T2DM_DX, T2DM_MED, distinct)
from cohortlab.operators import phenotype as ph
from cohortlab.plans.catalog import register
from cohortlab.sources.tables import Clinical, with_views


def _lst(values) -> str:
    return ",".join("'" + v.replace("'", "''") + "'" for v in distinct(values))


def _views(sql: str) -> str:
    return with_views(sql, "medications", "labevents", "dm_diagnoses")


_T2DX = f"SELECT DISTINCT subject_id FROM dm_diagnoses WHERE code NOT IN ({_lst(T1DM_DX)}) AND code IN ({_lst(T2DM_DX)})"
_MED2 = f"SELECT * FROM medications WHERE subject_id IN ({_T2DX})"
_T1P = f"SELECT DISTINCT subject_id FROM ({_MED2}) m WHERE lower(medicine) IN ({_lst(T1DM_MED)})"
_T2P = f"SELECT DISTINCT subject_id FROM ({_MED2}) m WHERE lower(medicine) IN ({_lst(T2DM_MED)})"
_FIRST = (f"SELECT subject_id, min(CASE WHEN lower(medicine) IN ({_lst(T1DM_MED)}) THEN med_date END) AS t1_date, "
          f"min(CASE WHEN lower(medicine) IN ({_lst(T2DM_MED)}) THEN med_date END) AS t2_date FROM ({_MED2}) m "
          f"WHERE lower(medicine) IN ({_lst(T1DM_MED + T2DM_MED)}) GROUP BY subject_id")
_FIRST_ALL = (f"SELECT subject_id, min(CASE WHEN lower(medicine) IN ({_lst(T1DM_MED)}) THEN med_date END) AS t1_date, "
              f"min(CASE WHEN lower(medicine) IN ({_lst(T2DM_MED)}) THEN med_date END) AS t2_date FROM medications "
              f"WHERE lower(medicine) IN ({_lst(T1DM_MED + T2DM_MED)}) GROUP BY subject_id")
_CASE1 = f"SELECT subject_id FROM ({_T2DX}) a WHERE NOT EXISTS (SELECT 1 FROM ({_T1P}) b WHERE b.subject_id = a.subject_id)"
_CASE2 = f"SELECT subject_id FROM ({_T1P}) a WHERE NOT EXISTS (SELECT 1 FROM ({_T2P}) b WHERE b.subject_id = a.subject_id)"
_CASE3 = f"SELECT subject_id FROM ({_FIRST}) f WHERE t1_date > t2_date"
_CASES = f"SELECT DISTINCT subject_id FROM ({_CASE1} UNION ALL {_CASE2} UNION ALL {_CASE3}) c"
_GLU = (f"SELECT DISTINCT subject_id FROM labevents WHERE (contains(test_name, 'glucose') OR contains(test_name, 'Glucose')) "
        f"AND NOT ((test_name IN ({_lst(GLUCOSE_FASTING_NAMES)}) AND value >= {GLUCOSE_BOUND}) OR "
        f"(test_name IN ({_lst(GLUCOSE_PLAIN_NAMES)}) AND value > {GLUCOSE_BOUND}))")
_CTRL = (f"SELECT DISTINCT subject_id FROM dm_diagnoses WHERE (code IS NULL OR code NOT IN ({_lst(DM_DX_RELATED)})) "
         f"AND subject_id IN ({_GLU})")
_UNIV = ("SELECT DISTINCT subject_id FROM (SELECT subject_id FROM labevents UNION ALL SELECT subject_id FROM dm_diagnoses "
         "UNION ALL SELECT subject_id FROM medications) u")
_PHENO_EXCL = (f"SELECT subject_id, 1 AS label FROM ({_CASES}) c UNION ALL SELECT subject_id, 0 AS label FROM ({_CTRL}) k "
               f"WHERE NOT EXISTS (SELECT 1 FROM ({_CASES}) x WHERE x.subject_id = k.subject_id) "
               f"UNION ALL SELECT subject_id, 3 AS label FROM ({_UNIV}) u WHERE NOT EXISTS (SELECT 1 FROM ({_CASES} "
               f"UNION ALL {_CTRL}) x WHERE x.subject_id = u.subject_id)")
_PHENO = (f"SELECT subject_id, 1 AS label FROM ({_CASES}) c UNION ALL SELECT subject_id, 0 AS label FROM ({_CTRL}) k "
          f"UNION ALL SELECT subject_id, 3 AS label FROM ({_UNIV}) u WHERE NOT EXISTS (SELECT 1 FROM ({_CASES} UNION ALL "
          f"{_CTRL}) x WHERE x.subject_id = u.subject_id)")


def _c(spark, d):
    c = Clinical(spark, d)
    return c.medications, c.labevents, c.dm_diagnoses.withColumnRenamed("dx_date", "date")


@register("dm_t2_diagnosed", _views(_T2DX))
def dm_t2_diagnosed(spark, d):
    _, _, dx = _c(spark, d)
    return ph.t2_diagnosed(dx)


@register("dm_t2_medication", _views(_MED2))
def dm_t2_medication(spark, d):
    med, _, dx = _c(spark, d)
    return ph.t2_medication(med, dx)


@register("dm_case_no_t1_med", _views(_CASE1))
def dm_case_no_t1_med(spark, d):
    med, _, dx = _c(spark, d)
    return ph.case_no_t1_medicine(dx, med)


@register("dm_case_no_t2_med", _views(_CASE2))
def dm_case_no_t2_med(spark, d):
    med, _, dx = _c(spark, d)
    return ph.case_no_t2_medicine(dx, med)


@register("dm_first_medication", _views(_FIRST))
def dm_first_medication(spark, d):
    med, _, dx = _c(spark, d)
    return ph.first_medication(dx, med)


@register("dm_case_t2_first", _views(_CASE3))
def dm_case_t2_first(spark, d):
    med, _, dx = _c(spark, d)
    return ph.case_t2_first(dx, med)


@register("dm_cases", _views(_CASES))
def dm_cases(spark, d):
    med, _, dx = _c(spark, d)
    return ph.cases(dx, med)


@register("dm_glucose_normal", _views(_GLU))
def dm_glucose_normal(spark, d):
    _, lab, _ = _c(spark, d)
    return ph.glucose_normal(lab)


@register("dm_controls", _views(_CTRL))
def dm_controls(spark, d):
    _, lab, dx = _c(spark, d)
    return ph.controls(lab, dx)


@register("dm_universe", _views(_UNIV))
def dm_universe(spark, d):
    med, lab, dx = _c(spark, d)
    return ph.universe(lab, dx, med)


@register("dm_phenotype", _views(_PHENO))
def dm_phenotype(spark, d):
    med, lab, dx = _c(spark, d)
    return ph.phenotype(med, lab, dx)


@register("dm_phenotype_steps", _views(_PHENO))
def dm_phenotype_steps(spark, d):
    med, lab, dx = _c(spark, d)
    return ph.phenotype(med, lab, dx, one_pass=False)


@register("dm_phenotype_exclusive", _views(_PHENO_EXCL))
def dm_phenotype_exclusive(spark, d):
    """One label per patient: a patient who is both a case and a control keeps the case label."""
    med, lab, dx = _c(spark, d)
    return ph.phenotype(med, lab, dx, exclusive=True)


@register("dm_case_t2_first_unrestricted", _views(f"SELECT subject_id FROM ({_FIRST_ALL}) f WHERE t1_date > t2_date"))
def dm_case_t2_first_unrestricted(spark, d):
    """Case 3 over every patient's medicines, without the T2-diagnosis restriction."""
    med, _, dx = _c(spark, d)
    return ph.case_t2_first(dx, med, restrict=False)
