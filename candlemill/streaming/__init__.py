"""The continuous queries: feed to Bronze, Bronze to Silver."""
