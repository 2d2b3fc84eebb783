"""Evidence-grounded analytics on Spark: sources, operators, checks and stored runs."""
