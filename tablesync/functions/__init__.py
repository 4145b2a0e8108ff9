"""Column -> Column building blocks; every function returns a JVM-side
expression except :func:`names.strip_accents`, which needs Unicode NFKD
(Spark SQL has none) and runs as an Arrow-batched UDF."""
