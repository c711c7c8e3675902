"""The three stages: shard, group, enrich."""
