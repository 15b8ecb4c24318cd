"""Snapshot feature and label store on Spark.

Monthly snapshots of loan and customer data become cleaned tables, a feature
store, a label store and vintage (bad-rate) analysis.  Every operator takes and
returns DataFrames; none of them loops over months or collects rows.
"""
