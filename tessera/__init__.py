"""tessera: recommendation analytics as Spark DataFrame plans.

Every public function takes DataFrames (and plain parameters) and returns a
lazy DataFrame.  Nothing is collected to the driver except scalars that are
provably small (a row count, a model's weight matrices in the embedding
trainer).  Sub-packages:

* ``sources``   -- readers / writers (ratings, transactions, sequences, samples,
                   embeddings, neighbour tables).
* ``functions`` -- column-level building blocks (stable hashing, distances,
                   gains and discounts, bucketing).
* ``operators`` -- the recommendation operators (item CF, rules, embeddings,
                   k-NN / LSH joins, retrieval and ranking metrics, list
                   utilities, samples and features, prediction evaluation).
* ``plans``     -- end-to-end jobs and the query registry used by
                   ``__spark_entry__`` and ``bench.py``.
"""

__version__ = "0.1.0"
