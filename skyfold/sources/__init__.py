from skyfold.sources.testdata import Tables  # noqa: F401
