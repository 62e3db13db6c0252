"""herdfeed: herd and feed record analytics as lazy Spark DataFrame transformations.

Entry points:

* ``herdfeed.plans.jobs.run_herd_job`` / ``run_feed_job`` — whole pipelines, sources to sinks
* ``herdfeed.operators.herd`` / ``herdfeed.operators.feed`` — the individual tables
* ``herdfeed.functions`` — Column -> Column cleaning and statistics rules
* ``herdfeed.sources`` / ``herdfeed.sinks`` — readers and writers
"""

__version__ = "0.1.0"
