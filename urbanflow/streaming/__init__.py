"""The row-wise jobs applied to an unbounded source."""
