"""Token-bridge analytics on PySpark: decode, stage, match, price and report."""
