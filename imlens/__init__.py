"""imlens: labelled-image and feature-vector analytics as Spark jobs.

Subpackages
-----------
sources    scans (binary files, decoded images, Parquet results) and sinks
functions  column expressions: path decoding, label rules, URI parts, vector helpers
operators  sampling, batched featurisation with a quarantine channel, standardise + PCA,
           classifiers, class balance and evaluation metrics
plans      end-to-end jobs (the train/test feature job) and the registered query set
streaming  incremental scoring of newly arriving image files with a fitted model
"""

__version__ = "0.1.0"
