"""Plans: verdict assembly, the reconcile runner, ledger (sweep) queries, profiles."""
