"""seqtable: datasets of user-interaction sequences as Spark jobs."""
