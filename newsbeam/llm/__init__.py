"""Training-data operators: one module per operator, their query bindings in
``registry``.  Nothing outside this package (and ``corpus_pipeline``) imports
it; the rest of the library works without it."""
