"""Plans.

* ``pipeline``  raw inputs -> cleaned inputs -> star schema (lazy or written)
* ``context``   the shared workspace per input folder or set of raw files
* ``insights``  the fifteen insight queries
* ``views``     the twenty-three views and ``register_views``
* ``checks``    the data-quality checks and constraint reports
* ``registry``  every query by name; ``run`` writes them all as a batch job
"""
