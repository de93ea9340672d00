"""DataFrame operators: contract checks, comparison, run state, keyed state, retention."""
