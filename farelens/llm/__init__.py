"""Training-data operators: one module per operator, bound to tables in ``registry``."""
