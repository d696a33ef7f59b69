"""Brute-force checks on small random fixtures with a hot key (one patient holds a third of the rows)."""

from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd

from cohortlab.functions.codes import ITEM_ID_TO_LABEL, VITAL_LABELS
from cohortlab.operators import vitals


def _fixture(seed: int = 7, n: int = 3000):
    rnd = random.Random(seed)
    ids = list(ITEM_ID_TO_LABEL) + [999999]
    anchor = dt.date(2024, 3, 1)
    patients = [(s, anchor + dt.timedelta(days=s % 5), 1 if s % 3 == 0 else 0) for s in range(1, 21)]
    rows = []
    for i in range(n):
        s = 1 if i % 3 == 0 else rnd.randint(2, 20)  # patient 1: a third of all rows
        day = anchor + dt.timedelta(days=rnd.randint(-45, 6))
        ts = dt.datetime.combine(day, dt.time(rnd.randint(0, 23), rnd.randint(0, 59)))
        v = None if rnd.random() < 0.1 else float(rnd.randint(30, 200))
        rows.append((s, ts, rnd.choice(ids), v))
    return rows, patients


def _pandas_features(rows, patients) -> pd.DataFrame:
    """The wide table computed the way a pandas user would, period by period."""
    chart = pd.DataFrame(rows, columns=["subject_id", "charttime", "itemid", "valuenum"])
    chart = chart[chart.itemid.isin(list(ITEM_ID_TO_LABEL))].copy()
    chart["label"] = chart.itemid.map(ITEM_ID_TO_LABEL)
    chart["chartDate"] = pd.to_datetime(chart.charttime.dt.date)
    pats = pd.DataFrame(patients, columns=["subject_id", "max_date", "angus"])
    pats["max_date"] = pd.to_datetime(pats.max_date)
    df = chart.merge(pats)
    df["lastDay"] = df.max_date - pd.to_timedelta(df.angus, unit="D")
    week, month = df.lastDay - pd.Timedelta("8 days"), df.lastDay - pd.Timedelta("31 days")
    masks = {"lastDay": df.chartDate == df.lastDay,
             "week": (df.chartDate < df.lastDay) & (df.chartDate >= week),
             "month": (df.chartDate < week) & (df.chartDate >= month),
             "history": pd.Series(True, index=df.index)}
    out = pats[["subject_id"]].copy()
    for p, m in masks.items():
        g = df[m].groupby(["subject_id", "label"]).valuenum
        stats = pd.DataFrame({"median": g.median(), "mean": g.mean(), "std": g.std(), "len": g.size()}).reset_index()
        for s in ["median", "mean", "std", "len"]:
            wide = stats.pivot(index="subject_id", columns="label", values=s)
            for lab in VITAL_LABELS:
                col = wide[lab] if lab in wide.columns else pd.Series(dtype=float)
                out[f"{p}_valuenum_{s}_{lab}"] = out.subject_id.map(col).fillna(0.0)
    return out.set_index("subject_id")


def test_vitals_features_match_pandas_with_hot_patient(spark):
    rows, patients = _fixture()
    chart = spark.createDataFrame(rows, "subject_id long, charttime timestamp_ntz, itemid int, valuenum double")
    pats = spark.createDataFrame(patients, "subject_id long, max_date date, angus int")
    got = vitals.vitals_features(chart, pats).toPandas().set_index("subject_id")
    want = _pandas_features(rows, patients)
    assert sorted(got.index) == sorted(want.index)
    for col in want.columns:
        for sid in want.index:
            a, b = float(got.at[sid, col]), float(want.at[sid, col])
            assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (sid, col, a, b)


def _sepsis_python(diag, proc, stays):
    """Three-branch rule in plain Python: explicit, or infection with organ dysfunction / ventilation."""
    from cohortlab.functions.codes import SEPSIS_CODE_SETS

    def hit(code, crit):
        return code is not None and any(code[:k] in set(v) for k, v in SEPSIS_CODE_SETS[crit].items())

    first = {}
    for s, h, d in stays:
        first[(s, h)] = min(first.get((s, h), d), d)
    flags = {}
    for rows, crits in ((diag, ["infection", "explicit_sepsis", "organ_dysfunction"]), (proc, ["mech_vent"])):
        for s, h, code in rows:
            for c in crits:
                if hit(code, c):
                    flags.setdefault((s, h), set()).add(c)
    out = {}
    for key, f in flags.items():
        if key not in first:
            continue
        septic = "explicit_sepsis" in f or ("infection" in f and ("organ_dysfunction" in f or "mech_vent" in f))
        if septic:
            out[key[0]] = min(out.get(key[0], first[key]), first[key])
    return out


def test_sepsis_date_matches_python_with_hot_admission(spark):
    from cohortlab.operators import cohort
    rnd = random.Random(11)
    codes = ["99592", "78552", "0389", "486", "5990", "49121", "5849", "4589", "2874", "570", "5695", None,
             "4019", "038", "9985", "V1"]
    pcodes = ["9670", "9671", "9672", "967", "3893", None]
    adm = lambda i: (1, 100) if i % 3 == 0 else (rnd.randint(2, 40), rnd.randint(1, 3))
    diag = [(*adm(i), rnd.choice(codes)) for i in range(3000)]
    proc = [(*adm(i), rnd.choice(pcodes)) for i in range(600)]
    base = dt.date(2024, 1, 1)
    stays = [(*adm(i), base + dt.timedelta(days=rnd.randint(0, 60))) for i in range(900)]
    d = spark.createDataFrame(diag, "subject_id long, hadm_id long, icd9_code string")
    p = spark.createDataFrame(proc, "subject_id long, hadm_id long, icd9_code string")
    st = spark.createDataFrame(stays, "subject_id long, hadm_id long, intime date")
    want = _sepsis_python(diag, proc, stays)
    for one_pass in (True, False):
        got = {r[0]: r[1] for r in cohort.sepsis_date(d, p, st, one_pass=one_pass).collect()}
        assert got == want


def test_phenotype_matches_python_with_hot_patient(spark):
    from cohortlab.functions.codes import (DM_DX_RELATED, GLUCOSE_FASTING_NAMES, GLUCOSE_PLAIN_NAMES, T1DM_DX,
                                           T1DM_MED, T2DM_DX, T2DM_MED)
    from cohortlab.operators import phenotype as ph
    rnd = random.Random(5)
    pid = lambda i: 1 if i % 3 == 0 else rnd.randint(2, 60)
    base = dt.date(2024, 1, 1)
    dx_codes = ["250.00", "250.02", "250.01", "790.21", "401.9", None]
    meds = ["Lantus", "insulin NPH", "Metformin", "glyburide", "aspirin", "ACTOS"]
    tests = ["Glucose", "Fasting Glucose", "glucose", "Sodium", "Glucose, Serum", "fasting plasma glucose"]
    dx = [(pid(i), base + dt.timedelta(days=rnd.randint(0, 90)), rnd.choice(dx_codes)) for i in range(1500)]
    md = [(pid(i), base + dt.timedelta(days=rnd.randint(0, 90)), rnd.choice(meds)) for i in range(1500)]
    lb = [(pid(i), rnd.choice(tests), float(rnd.randint(60, 160))) for i in range(900)]

    # plain Python, rule by rule
    t2 = {s for s, _, c in dx if c is not None and c not in T1DM_DX and c in T2DM_DX}
    m2 = [(s, d, m.lower()) for s, d, m in md if s in t2]
    t1p = {s for s, _, m in m2 if m in T1DM_MED}
    t2p = {s for s, _, m in m2 if m in T2DM_MED}
    f1 = {s: min(d for x, d, m in m2 if x == s and m in T1DM_MED) for s in t1p}
    f2 = {s: min(d for x, d, m in m2 if x == s and m in T2DM_MED) for s in t2p}
    cases = (t2 - t1p) | (t1p - t2p) | {s for s in t1p & t2p if f1[s] > f2[s]}

    def normal(name, v):
        glucose = "glucose" in name or "Glucose" in name
        high = (name in GLUCOSE_FASTING_NAMES and v >= 110) or (name in GLUCOSE_PLAIN_NAMES and v > 110)
        return glucose and not high
    lab_ok = {s for s, n, v in lb if normal(n, v)}
    controls = {s for s, _, c in dx if s in lab_ok and (c is None or c not in DM_DX_RELATED)}
    universe = {s for s, *_ in dx} | {s for s, *_ in md} | {s for s, *_ in lb}
    want = sorted([(s, 1) for s in cases] + [(s, 0) for s in controls] +
                  [(s, 3) for s in universe - cases - controls])

    d = spark.createDataFrame(dx, "subject_id long, date date, code string")
    m = spark.createDataFrame(md, "subject_id long, med_date date, medicine string")
    lab = spark.createDataFrame(lb, "subject_id long, test_name string, value double")
    for one_pass in (True, False):
        got = sorted(tuple(r) for r in ph.phenotype(m, lab, d, one_pass=one_pass).collect())
        assert got == want


def test_roc_per_model_matches_plain_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from cohortlab.operators import metrics
    rnd = random.Random(3)
    rows = [(name, i, rnd.randint(0, 1), rnd.randint(0, 1), round(rnd.random() * 20 - 10, 2))
            for name in ("a", "b") for i in range(400)]
    preds = spark.createDataFrame(rows, "model string, doc_id long, y int, h int, p double")
    ours = {(r["model"], r["threshold"]): (r["tp"], r["fp"]) for r in
            metrics.roc_curve(preds, by=["model"]).collect()}
    g = preds.groupBy("model", F.col("p").alias("threshold")).agg(
        F.sum((F.col("y") == 1).cast("long")).alias("pos"), F.sum((F.col("y") != 1).cast("long")).alias("neg"))
    w = Window.partitionBy("model").orderBy(F.col("threshold").desc())
    plain = {(r["model"], r["threshold"]): (r["tp"], r["fp"]) for r in g.select(
        "model", "threshold", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp")).collect()}
    assert ours == plain


def test_patient_terms_match_python_with_hot_patient(spark):
    import collections

    import regex

    from cohortlab.functions.text import STOP_WORDS
    from cohortlab.operators import notes
    from cohortlab.sources.tables import Clinical
    from cohort_test_tables import SF_SMALL

    docs = Clinical(spark, SF_SMALL).raw("documents").select("doc_id", "text").orderBy("doc_id").collect()
    base = dt.date(2024, 1, 1)
    rows = [(1 if i % 3 == 0 else 2 + i % 9, base + dt.timedelta(days=i % 20), d["doc_id"], d["text"])
            for i, d in enumerate(docs)]
    anchors = [(s, base + dt.timedelta(days=5 + s)) for s in range(1, 11)]
    stop = set(STOP_WORDS)
    want = collections.Counter()
    anchor_of = dict(anchors)
    for s, day, _, text in rows:
        if text is not None and day <= anchor_of[s]:
            for tok in regex.findall(r"\p{L}+", text.lower()):
                if tok not in stop:
                    want[(s, tok)] += 1
    nt = spark.createDataFrame(rows, "subject_id long, chartdate date, note_id long, text string")
    pt = spark.createDataFrame(anchors, "subject_id long, max_date date")
    got = {(r["subject_id"], r["term"]): r["n"] for r in notes.patient_terms(pt, nt).collect()}
    assert got == dict(want)
