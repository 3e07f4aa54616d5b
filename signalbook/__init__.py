"""Card-fraud scoring, listener cohorts, account classification and RFM
segmentation on PySpark.

Every public function takes DataFrames and returns DataFrames; the session is
the caller's.  See README.md for the map from questions to functions.
"""
