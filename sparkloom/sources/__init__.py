"""Sources, sinks, registries and generators."""
