"""The phases of the pipeline, composed of operators and expressions."""
