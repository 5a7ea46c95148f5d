"""hearth — housing-affordability analytics on Spark DataFrames.

Layers (each a plain DataFrame -> DataFrame function, built-in expressions only):

* ``hearth.functions``  column expressions: name normaliser, lenient number parsing,
  exact averages, guarded ratios.
* ``hearth.sources``    raw-input readers (declared schemas) and the mapping of the
  TPC-H-shaped test tables onto the housing inputs.
* ``hearth.operators``  cleaning steps, star-schema builders, data-quality checks and the
  level/ratio/statistics operators.
* ``hearth.plans``      the end-to-end pipeline (clean -> model -> materialise), the insight
  queries and the published views.
"""

__version__ = "0.1.0"
