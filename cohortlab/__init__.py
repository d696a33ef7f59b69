"""cohortlab — clinical cohort analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   typed readers / writers and the clinical projection of the test tables
* ``functions`` column-level building blocks (code sets, dates, text, vectors)
* ``operators`` DataFrame -> DataFrame operators (cohort dating, vitals, notes,
  phenotype, metrics)
* ``plans``     composite jobs (topic model, model comparison) and the query registry
"""

from cohortlab.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
