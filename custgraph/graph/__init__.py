"""Graph algorithms as iterative DataFrame jobs over one undirected projection."""
