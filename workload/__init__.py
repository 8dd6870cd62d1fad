"""The registered queries, each with the SQL that computes the same result."""
