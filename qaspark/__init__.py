"""qaspark: curate and evaluate question/answer and chat corpora on Spark.

Operators are plain ``DataFrame -> DataFrame`` functions with keyword
parameters; they live in ``qaspark.operators``, column expressions in
``qaspark.functions``, readers and writers in ``qaspark.sources``, stream
jobs in ``qaspark.streaming`` and query compositions in ``qaspark.plans``.
"""

__version__ = "0.1.0"
