"""Rules, joins, reconciliation, reshaping and reporting on DataFrames."""
