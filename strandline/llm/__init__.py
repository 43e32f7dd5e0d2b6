"""Training-data operators: language id, deduplication, decontamination, PII, packing and more.

Nothing outside this subpackage imports it. Every operator takes DataFrames and
returns DataFrames; intermediate results that must outlive an executor are
written below the folder named by ``spark.checkpoint.dir``.
"""
