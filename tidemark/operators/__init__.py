"""DataFrame operators: merge family, aggregates, packing, periods, increments."""
