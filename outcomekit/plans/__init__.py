"""End-to-end flows (preprocess, statistics, fit + evaluate) and the query
catalogue used by ``__spark_entry__``."""
