"""Table operators: aggregation, roll-up, encoding, ranking and assembly."""
