"""tallyworks: table analytics as composable PySpark DataFrame operators."""

__version__ = "0.1.0"
