"""The questions themselves: fraud, cohorts, accounts, RFM segments."""
