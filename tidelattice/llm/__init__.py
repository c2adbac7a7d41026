"""Training-data operators: one module per operator, shared array helpers, and their registered queries."""
