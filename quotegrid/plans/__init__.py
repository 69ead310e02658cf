"""Layer pipelines composed of the operators."""
