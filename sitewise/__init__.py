"""Fragmented order analytics on Spark: placement rules, fragments, change feeds."""
