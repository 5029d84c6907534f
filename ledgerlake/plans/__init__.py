"""Compositions: bronze, silver, gold marts, dashboard datasets, quality suite."""
