"""surveil — market-surveillance analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames (or small Python
values derived from a bounded aggregate).  Sub-packages:

* ``sources``   — readers, sinks and tick → bar aggregation
* ``functions`` — fixed constants, Column helpers and the feature registry
* ``operators`` — windows, scope filters, features, matching, models, metrics,
                  event analysis, text and universe operators
* ``plans``     — compositions over the driver tables (fixtures, training)
* ``streaming`` — Structured Streaming versions of bar building and scoring
"""

__version__ = "0.1.0"
