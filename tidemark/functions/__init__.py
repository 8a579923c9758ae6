"""Column and schema functions: type map, predicates, projections."""
