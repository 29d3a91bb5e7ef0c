"""Where rows come from: message topics, landed pages, result logs."""
