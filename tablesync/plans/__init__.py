"""The acting layer: sinks (writes, versioned commits) and composite jobs."""
