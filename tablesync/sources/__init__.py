"""Where rows come from: catalogues, relational tables, paged documents."""
