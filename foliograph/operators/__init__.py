"""DataFrame operators: entity resolution, networks, vectors, tagging, indicators."""
