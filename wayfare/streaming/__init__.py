"""Windows over event time, and the queries that keep their results in tables."""
