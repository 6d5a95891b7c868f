"""factorlab: recommendation analytics on Spark DataFrames.

Dense user/item indexing, rating tables and user-item matrices, plain-ridge Alternating
Least Squares, Spark ML ALS, prediction and top-N recommendation, user-user cosine
similarity and similarity-weighted scores, and a regressor on learnt factors. Every
operator maps DataFrames to DataFrames.
"""

__version__ = "0.1.0"
