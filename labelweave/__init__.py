"""labelweave: a Spark-native multi-label text classification engine.

Records (identifier, title, abstract) are normalised, tokenised, split into
overlapping token windows, scored by a pluggable model, pooled, thresholded
into collections, reconciled with curator overrides and kept in score /
collection tables; pipeline events become latency, throughput and gate
reports.  Every operator is a DataFrame function.
"""

__version__ = "0.1.0"
