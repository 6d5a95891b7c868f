"""Sources and sinks: review JSON, ratings derived from order tables, exported examples."""

from factorlab.sources.quarantine import split_rejects
from factorlab.sources.reviews import read_reviews_json, ratings_from_orders, clean_reviews, scan_reviews_json
from factorlab.sources.examples import read_examples_text

__all__ = ["read_reviews_json", "scan_reviews_json", "split_rejects", "ratings_from_orders", "clean_reviews",
           "read_examples_text"]
