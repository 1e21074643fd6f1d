"""Operators over DataFrames: keys, rules, relational queries, generators and maintenance."""
