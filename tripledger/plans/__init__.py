"""End-to-end plans: formatters per source, the three money views and the reconciliation report."""
