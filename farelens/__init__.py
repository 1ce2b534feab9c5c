"""Passenger-fare analytics as Spark DataFrame plans.

Sub-packages: ``sources`` (readers, extracts, projections, sinks), ``functions``
(column expressions and fixed values), ``operators`` (DataFrame to DataFrame
steps), ``plans`` (multi-step flows) and ``registry`` (every operator bound to the
supplied tables, with the SQL it is checked against).
"""
