"""Where rows come from and go to: landing files, layers, lookups, catalog."""
