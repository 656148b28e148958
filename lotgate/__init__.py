"""lotgate: gated intake of flat batch-measurement submissions on Spark.

Flat submissions are normalised into keyed reference and result tables,
checked against an ordered set of data-quality rules, audited when rejected,
and upserted when accepted.  Every step is a DataFrame-to-DataFrame function;
only ``lotgate.plans.publish`` writes.
"""

__version__ = "0.1.0"
