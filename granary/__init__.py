"""granary: inventory, demand and nutrition analytics as pure functions over DataFrames."""
