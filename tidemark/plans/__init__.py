"""Plans: the refresh, its store, publication, retention and the query catalogue."""
