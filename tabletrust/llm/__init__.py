"""Operators of a training-data pipeline, each an independent Spark job.

Every module holds one operator with a general interface; ``queries``
applies them to the driver tables with production parameters.  Nothing in
the rest of the library imports this package.
"""
