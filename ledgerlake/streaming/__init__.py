"""Stream jobs, and the batch forms that give the same answers on a captured stream."""
