"""Analytics over tracking and event data, expressed as Spark DataFrame operators."""
