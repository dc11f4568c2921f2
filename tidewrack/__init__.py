"""tidewrack: a Spark-native engine for preparing text corpora and training datasets
from paged social-media feeds."""

__version__ = "0.1.0"
