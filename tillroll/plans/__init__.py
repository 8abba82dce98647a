"""Pipeline stages as DataFrame plans: ingest, staging, marts, reports,
checks, model tests, ledger, and the end-to-end run."""
