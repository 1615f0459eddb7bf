"""Analytics over sampled database-session activity, written for Spark."""

__version__ = "0.1.0"
