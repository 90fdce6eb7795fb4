"""DataFrame operators: acquisition, merging, contracts, scanning and run audits."""
