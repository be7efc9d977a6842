"""tessera: DataFrame operators for behavioural and feature data on Spark.

Every operator takes and returns a DataFrame and stays lazy; Catalyst plans
the work. Subpackages:

* ``sources``   – file scans and sinks, plus fixture tables derived from the
                  shared test tables
* ``functions`` – Column expressions (hash draws, fixed-width fields, rules)
* ``operators`` – relational operators, feature preparation, models, reports
* ``plans``     – the named query catalog and its SQL twins
* ``streaming`` – intentionally empty (see its docstring)
"""

from tessera.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
