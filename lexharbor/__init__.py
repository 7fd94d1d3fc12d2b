"""lexharbor: chunking, store maintenance and hybrid retrieval over text collections, declared as Spark plans."""

__version__ = "0.1.0"
