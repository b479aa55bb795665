"""Query plans: the named catalog and runners, the shared-scan report, chart feeds, report metrics."""
