"""Where rows go: files, keyed tables, search indices."""
