"""Sources, normalisers and sinks."""
