"""Back-office reconciliation and voucher generation on Spark DataFrames."""
