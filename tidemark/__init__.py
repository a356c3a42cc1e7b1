"""tidemark: e-commerce event analytics as Spark DataFrame transforms.

Every operator is a ``DataFrame -> DataFrame`` function built from
Catalyst-visible expressions, so the same code plans into partial/final
hash aggregates, sort-merge joins and window operators at any scale.
"""

__version__ = "0.1.0"
