"""corpusmill: text-corpus pipelines as plain PySpark DataFrame transformations."""
