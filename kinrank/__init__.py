"""kinrank: collaborative filtering as distributed Spark DataFrame plans.

Rater quality, co-rated similarity (Pearson, overlap, cosine; user or item
mode), nearest neighbours, neighbourhood prediction and recommendation,
k-nearest-rater scoring, ALS factorisation, and held-out evaluation.
"""

__version__ = "0.1.0"
