"""Training-data operators: decontamination, near-duplicates, quality, language, mixing, sharding.

Self-contained: nothing outside this folder imports it. It uses only general helpers of the
library (the shared scratch folder).
"""
