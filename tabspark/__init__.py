"""tabspark: profiling, exploration and preparation of tabular data as Spark jobs."""

__version__ = "0.1.0"
