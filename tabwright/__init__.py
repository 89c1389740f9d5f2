"""tabwright: table preparation, feature building, splitting, training,
evaluation, scoring and profiling as lazy PySpark DataFrame operators."""

__version__ = "0.1.0"
