"""DataFrame operators: star joins, keyed merges, quality checks, rate audits."""
