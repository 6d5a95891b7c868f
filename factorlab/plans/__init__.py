"""End-to-end flows composing the operators (index → ALS → predict → recommend, …)."""
