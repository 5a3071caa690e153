"""Operators for building language-model training corpora with Spark.

Each module holds one operator with its general interface; ``queries``
registers the ``opN_*`` queries that apply them to whole tables."""
