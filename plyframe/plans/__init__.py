"""The tables of the pipeline and the analyses on them, each ``DataFrame -> DataFrame``."""
