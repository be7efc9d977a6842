"""DataFrame -> DataFrame operators, grouped by kind.

* ``shape``    – projections, filters, labels, weights (P)
* ``match``    – anti/semi/inner joins, union (J, U)
* ``summary``  – aggregates, profiles, statistics, top-k (A, O)
* ``rank``     – exact ranks without single-task windows
* ``sample``   – reproducible splits and resampling (M, W)
* ``features`` – vectors, scaling, string indexing (F)
* ``models``   – Spark ML fits and scoring (L, R)
* ``evaluate`` – binary, per-class and ranking reports (E)
"""
