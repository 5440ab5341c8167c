"""ratelens: review-trust analytics expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
