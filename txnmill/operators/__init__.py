"""Table operators: ``DataFrame -> DataFrame`` functions, usable with ``df.transform``."""
