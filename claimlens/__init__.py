"""claimlens: warranty-claims analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` so Catalyst sees the
whole chain; actions happen only at sinks.
"""

__version__ = "0.1.0"
