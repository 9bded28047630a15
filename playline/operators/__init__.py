"""DataFrame to DataFrame operators, for use with ``DataFrame.transform``."""
