"""quire — document analytics on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
DataFrame/SQL expressions so Catalyst can prune, push down and codegen it.
Python only enters through Arrow-batched ``mapInPandas`` hooks for
pluggable model functions.
"""

__version__ = "0.1.0"
