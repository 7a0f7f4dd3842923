"""Panelith: panel analytics (entity x date) written as Spark DataFrame operators."""

__version__ = "0.1.0"
