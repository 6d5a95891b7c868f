"""DataFrame operators: indexing, rating tables, ALS, prediction, metrics, recommendation,
similarity, Spark ML ALS and the latent-vector regressor."""
