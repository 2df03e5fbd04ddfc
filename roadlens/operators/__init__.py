"""DataFrame operators: selection, sequencing, tracks and paths, sampling, monitors, areas, follow-car."""
