"""DataFrame-in, DataFrame-out operators, usable on batch tables and streams."""
