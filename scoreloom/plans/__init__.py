"""Plan-level building blocks: size checks, durable cuts and skew-proof ordering."""
