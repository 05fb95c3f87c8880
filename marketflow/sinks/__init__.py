"""Writers for bars, results and documents."""
