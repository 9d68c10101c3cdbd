"""Compositions of the operators.

* :mod:`~lakestar.plans.entities` - declarative entity specs and the generic
  silver job (flatten, gate, latest, clean, keys, upsert).
* :mod:`~lakestar.plans.racing` - the racing configuration: seven raw
  entities, silver, gold star, report, questions, run order.
* :mod:`~lakestar.plans.star` - the same steps on the synthetic test tables,
  with full publish and incremental refreshes.
* :mod:`~lakestar.plans.acceptance` / :mod:`~lakestar.plans.oracle` - the
  registered queries and their DuckDB SQL.
"""
