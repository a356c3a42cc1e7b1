"""The shop-analytics operators, each a parameterised DataFrame transform."""
