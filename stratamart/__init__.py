"""stratamart: layered analytical tables (raw, cleaned, star schema) as plain Spark DataFrame functions."""

from stratamart.spec import ForeignKey, Model, Pipeline, SaveMode, TableSpec

__all__ = ["ForeignKey", "Model", "Pipeline", "SaveMode", "TableSpec"]
