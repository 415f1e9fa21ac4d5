"""The two table sets (shop, goods movements) and their runs."""
