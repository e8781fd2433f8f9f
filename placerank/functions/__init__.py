"""Column builders. Everything here stays inside generated JVM code; no Python UDF."""
