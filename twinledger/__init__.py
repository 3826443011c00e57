"""Trade-ledger consistency jobs on Spark: cleanse, validate, load two stores, audit, replay, report."""
