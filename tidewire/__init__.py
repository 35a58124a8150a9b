"""Communications and data-quality engine: every operator is ``DataFrame -> DataFrame``."""
