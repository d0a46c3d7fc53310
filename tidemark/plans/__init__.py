"""Jobs: compositions of operators that read sources and write tables."""
