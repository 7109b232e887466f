"""Plans: the batch pipeline, dashboard reads, registered queries, benchmark baseline."""
