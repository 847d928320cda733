"""Plans: wiring of the layers, the query catalogue and the oracle SQL."""
