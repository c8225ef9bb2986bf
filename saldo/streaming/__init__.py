"""streaming of the payment analytics library."""
