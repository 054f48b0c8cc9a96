"""docshred — shred nested JSON documents into relational tables with Spark.

Entry points:
    docshred.plans.pipeline.build(spark, path, dictionaries)  → tables, checks, dedup
    docshred.operators.shredder.shred(docs, spec)                → one table
"""

__version__ = "0.1.0"
