"""DataFrame-to-DataFrame operators. None of them runs a Spark action."""
