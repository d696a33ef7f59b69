"""Registered queries: sepsis criteria, sepsis date, last record date, patient details."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlab.functions.codes import SEPSIS_CODE_SETS
from cohortlab.operators import code_rules, cohort
from cohortlab.plans.catalog import register
from cohortlab.sources.tables import Clinical, with_views


def _sql_match(criterion: str, code_col: str = "icd9_code") -> str:
    """Boolean SQL test: some k-character prefix of the code is in the criterion's k-list."""
    tests = []
    for k, codes in sorted(SEPSIS_CODE_SETS[criterion].items()):
        tests.append(f"left({code_col}, {k}) IN ({', '.join(repr(c) for c in codes)})")
    return "(" + " OR ".join(tests) + ")"


def _sql_flag(criterion: str, code_col: str = "icd9_code") -> str:
    return f"CASE WHEN coalesce({_sql_match(criterion, code_col)}, false) THEN 1 ELSE 0 END"


def _sql_criterion_time(criterion: str, table: str) -> str:
    """Admissions with a code of the criterion and a stay: first stay day."""
    return (f"SELECT subject_id, hadm_id, 1 AS {criterion}, min(s.intime) AS {criterion}_time "
            f"FROM (SELECT DISTINCT subject_id, hadm_id FROM {table} WHERE {_sql_match(criterion)}) h "
            f"JOIN icustays s USING (subject_id, hadm_id) GROUP BY subject_id, hadm_id")


def _last_sql(table: str, col: str) -> str:
    return f"SELECT subject_id, max(cast({col} AS date)) AS final_date FROM {table} GROUP BY subject_id"


# --- flags (P6-P9) -----------------------------------------------------------

def _flag_query(criterion: str, table: str, extra_cols: list[str]):
    def q(spark, d):
        c = Clinical(spark, d)
        src = c.diagnoses_icd if table == "diagnoses_icd" else c.procedures_icd
        return cohort.with_code_flag(src, criterion).select("subject_id", "hadm_id", *extra_cols, "icd9_code",
                                                            criterion)
    cols = ", ".join(["subject_id", "hadm_id", *extra_cols, "icd9_code"])
    return q, with_views(f"SELECT {cols}, {_sql_flag(criterion)} AS {criterion} FROM {table}", table)


for _crit, _tab, _extra in [("infection", "diagnoses_icd", ["seq_num"]),
                            ("explicit_sepsis", "diagnoses_icd", ["seq_num"]),
                            ("organ_dysfunction", "diagnoses_icd", ["seq_num"]),
                            ("mech_vent", "procedures_icd", [])]:
    _q, _sql = _flag_query(_crit, _tab, _extra)
    register(f"flag_{_crit}", _sql)(_q)


_ALL_CODES_SQL = ("SELECT subject_id, hadm_id, 'D' AS kind, icd9_code FROM diagnoses_icd UNION ALL "
                  "SELECT subject_id, hadm_id, 'P' AS kind, icd9_code FROM procedures_icd")


@register("code_set_flags", with_views(
    f"SELECT subject_id, hadm_id, kind, icd9_code, {', '.join(f'{_sql_flag(c)} AS {c}' for c in SEPSIS_CODE_SETS)} FROM ({_ALL_CODES_SQL}) u",
    "diagnoses_icd", "procedures_icd"))
def code_set_flags(spark, d):
    """All four flags of every diagnosis and procedure, from the rule table."""
    c = Clinical(spark, d)
    codes = c.diagnoses_icd.select("subject_id", "hadm_id", F.lit("D").alias("kind"), "icd9_code").unionByName(
        c.procedures_icd.select("subject_id", "hadm_id", F.lit("P").alias("kind"), "icd9_code"))
    return code_rules.with_flags(codes, code_rules.rule_table(spark, SEPSIS_CODE_SETS), list(SEPSIS_CODE_SETS))


# --- joins with ICU stays (J1, J2) --------------------------------------------

@register("diag_icu_join", with_views(
    "SELECT A.subject_id, A.hadm_id, A.seq_num, A.icd9_code, B.intime FROM diagnoses_icd A JOIN icustays B "
    "ON A.hadm_id = B.hadm_id AND A.subject_id = B.subject_id", "diagnoses_icd", "icustays"))
def diag_icu_join(spark, d):
    c = Clinical(spark, d)
    return cohort.codes_icu_join(c.diagnoses_icd, c.icustays).select(
        "subject_id", "hadm_id", "seq_num", "icd9_code", "intime")


@register("proc_icu_join", with_views(
    "SELECT A.subject_id, A.hadm_id, A.icd9_code, B.intime FROM procedures_icd A JOIN icustays B "
    "ON A.hadm_id = B.hadm_id AND A.subject_id = B.subject_id", "procedures_icd", "icustays"))
def proc_icu_join(spark, d):
    c = Clinical(spark, d)
    return cohort.codes_icu_join(c.procedures_icd, c.icustays).select("subject_id", "hadm_id", "icd9_code", "intime")


# --- first criterion time per admission (A5-A8) --------------------------------

def _time_query(criterion: str, table: str):
    def q(spark, d):
        c = Clinical(spark, d)
        src = c.diagnoses_icd if table == "diagnoses_icd" else c.procedures_icd
        return cohort.criterion_time(src, c.icustays, criterion)
    return q, with_views(_sql_criterion_time(criterion, table), table, "icustays")


for _crit, _tab in [("infection", "diagnoses_icd"), ("explicit_sepsis", "diagnoses_icd"),
                    ("organ_dysfunction", "diagnoses_icd"), ("mech_vent", "procedures_icd")]:
    _q, _sql = _time_query(_crit, _tab)
    register(f"{_crit}_time", _sql)(_q)


# --- pairs of criteria (J3, J4, P12) -----------------------------------------------

def _pair_sql(a: str, ta: str, b: str, tb: str) -> str:
    return with_views(
        f"SELECT X.subject_id, X.hadm_id, CASE WHEN X.{a}_time > Y.{b}_time THEN X.{a}_time ELSE Y.{b}_time END AS sep_time "
        f"FROM ({_sql_criterion_time(a, ta)}) X JOIN ({_sql_criterion_time(b, tb)}) Y USING (subject_id, hadm_id)",
        *sorted({ta, tb}), "icustays")


@register("sepsis_infection_organ", _pair_sql("infection", "diagnoses_icd", "organ_dysfunction", "diagnoses_icd"))
def sepsis_infection_organ(spark, d):
    c = Clinical(spark, d)
    return cohort.combined_time(cohort.criterion_time(c.diagnoses_icd, c.icustays, "infection"),
                                cohort.criterion_time(c.diagnoses_icd, c.icustays, "organ_dysfunction"),
                                "infection", "organ_dysfunction")


@register("sepsis_infection_vent", _pair_sql("infection", "diagnoses_icd", "mech_vent", "procedures_icd"))
def sepsis_infection_vent(spark, d):
    c = Clinical(spark, d)
    return cohort.combined_time(cohort.criterion_time(c.diagnoses_icd, c.icustays, "infection"),
                                cohort.criterion_time(c.procedures_icd, c.icustays, "mech_vent"),
                                "infection", "mech_vent")


@register("later_of_dates", with_views(
    "SELECT X.subject_id, X.final_date AS chart_date, Y.final_date AS note_date, "
    "CASE WHEN X.final_date > Y.final_date THEN X.final_date ELSE Y.final_date END AS later_date "
    f"FROM ({_last_sql('chartevents', 'charttime')}) X LEFT JOIN ({_last_sql('noteevents', 'charttime')}) Y USING (subject_id)",
    "chartevents", "noteevents"))
def later_of_dates(spark, d):
    """Later of two days that differ either way: a patient's last chart day and last note day."""
    from cohortlab.functions.expressions import later_of
    c = Clinical(spark, d)
    x = cohort.last_date(c.chartevents, "charttime").withColumnRenamed("final_date", "chart_date")
    y = cohort.last_date(c.noteevents, "charttime").withColumnRenamed("final_date", "note_date")
    return x.join(y, "subject_id", "left").select("subject_id", "chart_date", "note_date",
                                                  later_of("chart_date", "note_date").alias("later_date"))


# --- sepsis date (K1, flagship) ----------------------------------------------------

SEPSIS_DATE_BODY = (
    f"SELECT subject_id, min(sep_time) AS sepsis_date FROM ("
    f" SELECT subject_id, hadm_id, explicit_sepsis_time AS sep_time FROM ({_sql_criterion_time('explicit_sepsis', 'diagnoses_icd')}) E"
    f" UNION ALL SELECT X.subject_id, X.hadm_id, CASE WHEN X.infection_time > Y.organ_dysfunction_time THEN X.infection_time "
    f"ELSE Y.organ_dysfunction_time END FROM ({_sql_criterion_time('infection', 'diagnoses_icd')}) X JOIN "
    f"({_sql_criterion_time('organ_dysfunction', 'diagnoses_icd')}) Y USING (subject_id, hadm_id)"
    f" UNION ALL SELECT X.subject_id, X.hadm_id, CASE WHEN X.infection_time > Y.mech_vent_time THEN X.infection_time "
    f"ELSE Y.mech_vent_time END FROM ({_sql_criterion_time('infection', 'diagnoses_icd')}) X JOIN "
    f"({_sql_criterion_time('mech_vent', 'procedures_icd')}) Y USING (subject_id, hadm_id)"
    f") U GROUP BY subject_id")
SEPSIS_DATE_SQL = with_views(SEPSIS_DATE_BODY, "diagnoses_icd", "procedures_icd", "icustays")


@register("sepsis_date", SEPSIS_DATE_SQL)
def sepsis_date(spark, d):
    c = Clinical(spark, d)
    return cohort.sepsis_date(c.diagnoses_icd, c.procedures_icd, c.icustays)


@register("sepsis_date_branches", SEPSIS_DATE_SQL)
def sepsis_date_branches(spark, d):
    c = Clinical(spark, d)
    return cohort.sepsis_date(c.diagnoses_icd, c.procedures_icd, c.icustays, one_pass=False)


# --- last record date (K2: A1-A4, U1) -------------------------------------------------

@register("last_lab_date", with_views(_last_sql("labevents", "charttime"), "labevents"))
def last_lab_date(spark, d):
    return cohort.last_date(Clinical(spark, d).labevents, "charttime")


@register("last_chart_date", with_views(_last_sql("chartevents", "charttime"), "chartevents"))
def last_chart_date(spark, d):
    return cohort.last_date(Clinical(spark, d).chartevents, "charttime")


@register("last_note_date", with_views(_last_sql("noteevents", "charttime"), "noteevents"))
def last_note_date(spark, d):
    return cohort.last_date(Clinical(spark, d).noteevents, "charttime")


LAST_RECORD_SQL = (
    f"SELECT subject_id, max(final_date) AS final_date FROM ({_last_sql('labevents', 'charttime')} UNION ALL "
    f"{_last_sql('chartevents', 'charttime')} UNION ALL {_last_sql('noteevents', 'charttime')}) U GROUP BY subject_id")


def last_record_sources(c: Clinical):
    return [(c.labevents, "charttime"), (c.chartevents, "charttime"), (c.noteevents, "charttime")]


@register("last_record_date", with_views(LAST_RECORD_SQL, "labevents", "chartevents", "noteevents"))
def last_record_date(spark, d):
    return cohort.last_record_date(last_record_sources(Clinical(spark, d)))


# --- patient details (J11 / K4) --------------------------------------------------------

DETAILS_SQL = (
    f"SELECT coalesce(L.subject_id, S.subject_id) AS subject_id, coalesce(S.sepsis_date, L.final_date) AS max_date, "
    f"CASE WHEN S.sepsis_date IS NULL THEN 0 ELSE 1 END AS angus FROM ({LAST_RECORD_SQL}) L FULL OUTER JOIN "
    f"({SEPSIS_DATE_BODY}) S ON L.subject_id = S.subject_id")
DETAILS_VIEWS = ("labevents", "chartevents", "noteevents", "diagnoses_icd", "procedures_icd", "icustays")


def with_details(sql: str) -> str:
    """``sql`` over a ``patient_anchor`` that is the patient details computed from the clinical tables."""
    return with_views(f"WITH patient_anchor AS (SELECT *, 0 AS first_admit_age FROM ({DETAILS_SQL}) x)\n"
                      + (f",{sql.lstrip()[5:]}" if sql.lstrip()[:5].upper() == "WITH " else sql), *DETAILS_VIEWS)


@register("patient_details", with_views(DETAILS_SQL, *DETAILS_VIEWS))
def patient_details(spark, d):
    c = Clinical(spark, d)
    return cohort.patient_details(cohort.last_record_date(last_record_sources(c)),
                                  cohort.sepsis_date(c.diagnoses_icd, c.procedures_icd, c.icustays))
