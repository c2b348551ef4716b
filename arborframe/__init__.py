"""Forest plot measurement on Spark: point clouds in, tree and plot tables out."""

__version__ = "0.1.0"
