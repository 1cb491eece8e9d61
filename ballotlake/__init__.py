"""Voter-engagement analytics as PySpark DataFrame jobs.

Sub-packages: ``sources`` (scans), ``functions`` (Column builders), ``operators``
(DataFrame building blocks), ``plans`` (the datasets a user asks for) and
``streaming`` (file-stream ingest).
"""
