"""DataFrame operators: joins, filters, aggregates, statistics, samples, checks."""
