"""Event catalogues and keyed time series turned into labelled, balanced datasets on Spark."""
