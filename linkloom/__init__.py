"""linkloom: record linkage and list evaluation as Spark plans."""
