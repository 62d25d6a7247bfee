"""Where rows come from: CSV files, lake and published tables, the supplied test tables."""
