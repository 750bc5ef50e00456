"""Consumer-complaint analytics as PySpark DataFrame operators.

The package is organised by what an operator does:

* ``redress.sources``   - scans, sinks, the catalog and the repair load
* ``redress.functions`` - column expressions (text, dates, rates)
* ``redress.operators`` - joins, aggregates, windows, keys, audits
* ``redress.plans``     - star build, cleaning, KPIs and the layer flow
"""
