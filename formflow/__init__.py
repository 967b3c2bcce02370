"""formflow: form-data flattening and field-programme analytics on Spark."""

__version__ = "0.1.0"
