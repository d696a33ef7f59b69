"""Compare a registered query with its DuckDB oracle (test / tooling helper).

Both results go through Arrow; the comparison checks column names, Arrow
types, row count and the multiset of rows (floats rounded to 6 places).
DuckDB is imported lazily: the library itself does not need it.
"""

from __future__ import annotations

import os
import time

from cohortlab.plans import catalog
from cohortlab.sources.tables import RAW_TABLES

_TYPE_ALIASES = {"large_string": "string", "string_view": "string"}


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in RAW_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(pdf) -> list[tuple]:
    import pandas as pd
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for rec in pdf.itertuples(index=False, name=None):
        out = []
        for v in rec:
            if v is None or (isinstance(v, float) and v != v) or v is pd.NaT:
                out.append("NULL")
            elif isinstance(v, float):
                out.append(repr(round(v, 6)))
            elif hasattr(v, "isoformat"):
                out.append(str(pd.Timestamp(v)))
            elif hasattr(v, "tolist"):
                out.append(repr(v.tolist()))
            else:
                out.append(repr(v))
        rows.append(tuple(out))
    return sorted(rows)


def compare(spark, con, key: str, sf_dir: str) -> dict:
    t0 = time.time()
    sarrow = catalog.QUERIES[key](spark, sf_dir).toArrow()
    res = {"key": key, "rows": sarrow.num_rows, "spark_sec": round(time.time() - t0, 2)}
    sql = catalog.ORACLES.get(key)
    if sql is None:
        res["status"] = "rows-only"
        return res
    darrow = con.sql(sql).arrow().read_all()
    res["oracle_rows"] = darrow.num_rows
    if sorted(sarrow.column_names) != sorted(darrow.column_names):
        res["status"] = f"COLUMNS {sorted(sarrow.column_names)} vs {sorted(darrow.column_names)}"
        return res
    ta = {f.name: _TYPE_ALIASES.get(str(f.type), str(f.type)) for f in sarrow.schema}
    tb = {f.name: _TYPE_ALIASES.get(str(f.type), str(f.type)) for f in darrow.schema}
    if ta != tb:
        res["types"] = {c: [ta[c], tb[c]] for c in ta if ta[c] != tb[c]}
    a, b = canon(sarrow.to_pandas()), canon(darrow.to_pandas())
    if a == b:
        res["status"] = "match" if "types" not in res else "match-values-only"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "MISMATCH"
        res["only_spark"] = [list(x) for x in list(sa - sb)[:3]]
        res["only_oracle"] = [list(x) for x in list(sb - sa)[:3]]
    return res
