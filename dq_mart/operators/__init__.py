"""DataFrame -> DataFrame operators: cleaning, conforming, profiling,
integrity checks and analytics."""
