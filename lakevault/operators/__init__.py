"""DataFrame-in, DataFrame-out operators of the bronze, vault, gold and mart layers."""
