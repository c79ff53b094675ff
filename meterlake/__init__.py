"""meterlake: half-hourly meter-reading analytics on Spark DataFrames.

Layers:

* ``sources``   – Bronze scans, date slices, profiles, the test-data adapter.
* ``functions`` – reusable Column expressions (slots, labels, safe casts).
* ``operators`` – Silver derivations, the z-score quality policy, Gold aggregates.
* ``plans``     – composite queries: QA checks, insights, chart datasets, jobs.
* ``sinks``     – partition overwrite, run log, JSON export, table registration.
* ``streaming`` – incremental trigger for the daily job over a landing folder.

Library use::

    from meterlake.session import get_spark
    from meterlake.sources import read_bronze
    from meterlake.plans.layers import build_layers
    from meterlake.plans import insights, qa

    spark = get_spark()
    layers = build_layers(read_bronze(spark, "s3a://bucket/bronze"), start="2024-01-01", end="2024-01-30")
    insights.top_substations(layers.peak).show()
    qa.qa_suite(layers.silver, layers.peak, layers.profile, "2024-01-12").show()
"""

__version__ = "0.1.0"
