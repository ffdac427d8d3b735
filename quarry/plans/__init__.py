"""Builds wired from operators: silver (validate/quarantine/dedup), gold (star schema),
serving queries, and the driver's analogue queries over the supplied tables."""
