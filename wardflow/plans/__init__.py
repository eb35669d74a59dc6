"""Gold layer: fact projections and the five indicators as lazy plans."""
