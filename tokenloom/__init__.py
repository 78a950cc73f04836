"""tokenloom: corpus tokenization and language-model data jobs on Spark DataFrames."""
