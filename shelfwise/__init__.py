"""shelfwise: a Spark-native title-catalog pipeline and recommender.

Every operator is a ``DataFrame -> DataFrame`` function on the public PySpark
API, meant to be chained with ``df.transform``:

* ``shelfwise.sources``   - table readers/writers, fixture views, snapshots
* ``shelfwise.functions`` - column expressions (parsing, text, stop words)
* ``shelfwise.operators`` - cleaning, constraints, keys, normalisation,
  extraction, marts, TF-IDF features, recommendations
* ``shelfwise.plans``     - the composed jobs (clean chain, star build/read,
  recommender corpus)
* ``shelfwise.streaming`` - micro-batch (Structured Streaming) variants
"""

__version__ = "0.1.0"
