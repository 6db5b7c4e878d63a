"""Layer models, bindings, the cleaning job and the pipeline."""
