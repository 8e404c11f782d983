"""Incident analytics on Spark: extract, ingest, clean, enrich, aggregate, model, report.

Every operator is a plain ``DataFrame -> DataFrame`` function (use it with ``df.transform``) or a
``Column -> Column`` function; nothing here collects rows.  The modules under ``plans`` join the
operators into the jobs that read and write tables.
"""
