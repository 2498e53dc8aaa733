"""tollgate: bulk pre-flight governance of AI traffic on Spark.

Every public function takes and returns DataFrames (or Columns), so a whole
governance job -- read, extract, gate, detect, normalise, decide, route -- is
one Catalyst plan.
"""

__version__ = "0.1.0"
