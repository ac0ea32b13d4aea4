"""Daily and weekly statistics over the raw tables of a block-based ledger."""
