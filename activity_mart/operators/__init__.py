"""Table operators: cleaning, keys, star schema, measures and expectations."""
