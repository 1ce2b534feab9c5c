"""DataFrame to DataFrame steps.  None of them collects rows to the driver."""
