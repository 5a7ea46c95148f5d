"""DataFrame operators.

* ``cleaning``  text-cleaning steps (lenient parsing, blank handling, remaps, NOT NULL rules)
* ``model``     star-schema builders (region and date dimensions, bridge, three facts)
* ``quality``   data-quality reports (duplicates, orphans, unmatched names, profiles, constraints)
* ``levels``    national / region / district means and income ratios
* ``keys``      distributed dense surrogate keys
* ``joins``     size-checked broadcast
"""
