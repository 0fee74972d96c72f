"""Query plans over the driver tables, and helpers of the runtime."""
