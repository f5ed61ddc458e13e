"""Department KPIs and whole jobs."""
