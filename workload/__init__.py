"""The registered queries: incident tables derived from ``events``, and their SQL twins."""
