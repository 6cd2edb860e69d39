"""Drug-response data jobs on Spark: selection, alignment, pairing, consensus, evaluation."""
