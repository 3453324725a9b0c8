"""Where rows come from and go to: topics, the history table, the registry."""
