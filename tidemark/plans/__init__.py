"""Jobs, replay, reports and generated tables built from the operators."""
