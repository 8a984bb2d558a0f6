"""DataFrame-to-DataFrame operators: joins, roster, registrations, reconciliation, scorecards, trends, maps."""
