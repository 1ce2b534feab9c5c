"""Column expressions (``columns``) and fixed values (``fixed``)."""
