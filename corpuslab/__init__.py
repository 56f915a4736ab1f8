"""corpuslab: a Spark-native engine for transcript corpora, n-gram language
models, collocations, sampling, features, nearest-neighbour classification,
vector similarity and prompt evaluation. Everything is expressed with the
DataFrame API so Catalyst and adaptive execution plan the work."""

__version__ = "0.1.0"
