"""DataFrame builders: ODS, vault, marts, analyst reports and data checks."""
