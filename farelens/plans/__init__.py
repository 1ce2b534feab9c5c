"""Multi-step flows: data sets for the models, the demand profile and the scenario."""
