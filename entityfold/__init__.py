"""Join a register of entities with its side registers into one document per entity, on Spark."""
