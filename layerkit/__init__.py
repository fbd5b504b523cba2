"""layerkit: medallion and retail-warehouse data jobs written as Spark DataFrame plans."""

__version__ = "0.1.0"
