"""Where rows come from. Every text source yields a ``value`` column."""
