"""Passbook: account-ledger analytics on Spark.

Overlapping account snapshots go in; a star schema, report marts and
parameterised report queries come out.  Every builder is a plain function from
DataFrames to a lazy DataFrame, so plans compose and Catalyst sees one query.
"""
